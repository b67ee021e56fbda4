"""Operator 5: MinHash near-dedup on 5-word shingles.

*Circulant MinHash*: two permutations of the circle of 2^32 shingle codes
generate all signature coordinates; the first breaks up structure, the second
is shifted by one step for each further coordinate.  Both are keyed bijective
mixers, so no table of a permutation is held.  Coordinates are banded; a
band's key makes a bucket, and documents of a bucket are candidates.

All candidates are settled on full shingle sets:

1. Documents of equal sets are one representative, so copies cost one row.
2. Every bucket member is compared with the bucket's least member; the links
   found give first components.
3. In buckets whose members are not yet in one component, every member outside
   the bucket's largest component is compared with every member of another
   component: both sides are cut into blocks of ``BLOCK`` members, and each
   pair of blocks is a group of its own.  Buckets of the same members are
   settled once.

So no pair of a bucket that could join two components is left out, no pair
list of a bucket is ever made, and a bucket of any size is bounded groups.
Shingles are held as 64-bit codes.  A pair at the threshold shares no bucket
with probability (1 - 0.75^ROWS)^BANDS, about 1e-6.

Defined results: null text, empty text and text without words have no
shingles and are linked with nothing; rows without an id are linked with
nothing and kept; rows repeated under an id are linked by their texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_groups, written
from .components import connected_components

#: Words of a shingle; links have 100 * intersection >= PERCENT * union.
WIDTH, PERCENT = 5, 75
BANDS, ROWS, BLOCK, SEED = 36, 4, 256, 99
#: Bytes of a text whose words are held at once.
PIECE = 4_000_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Odd multipliers of the words of a shingle, of a short text's words, and of a band's coordinates.
_ODD = [int(x) | 1 for x in np.random.default_rng(SEED).integers(1, 2**63, 3 * WIDTH, dtype=np.int64)]


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_codes(text: str) -> np.ndarray:
    """64-bit codes of the words, A-Z lower-cased (bytes.lower and bytes.split know ASCII only)."""
    data, parts, at = text.encode().lower(), [], 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
        end = cut.start() if cut else len(data)
        words = data[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct codes of the text's shingles; of fewer words, one code of the sequence."""
    codes = word_codes(text or "")
    n = len(codes)
    if n == 0:
        return codes
    if n < WIDTH:
        total = sum(int(c) * _ODD[WIDTH + j] for j, c in enumerate(codes)) + n
        return _mix64(np.array([total % 2**64], np.uint64))
    total = np.zeros(n - WIDTH + 1, np.uint64)
    for j in range(WIDTH):
        total += codes[j:n - WIDTH + 1 + j] * np.uint64(_ODD[j])
    return np.unique(_mix64(total))


def _permute32(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of the 32-bit codes, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(13)
    x *= np.uint32(b)
    return x


def signature(codes: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: the minimum of the second permutation, shifted k steps, for each k."""
    first = _permute32(np.unique(codes.astype(np.uint32)), 0x85EBCA6B, 0xC2B2AE35)
    first ^= first >> np.uint32(16)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(first), 512):
        turned = first[None, at:at + 512] - shifts          # modulo 2^32: a circle
        np.minimum(least, _permute32(turned, 0x7FEB352D, 0x846CA68B).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = least.reshape(bands, rows).astype(np.uint64)
    total = np.arange(bands, dtype=np.uint64) * np.uint64(_ODD[-1])
    for j in range(rows):
        total = _mix64(total ^ parts[:, j] * np.uint64(_ODD[2 * WIDTH + j % WIDTH]))
    return total.view(np.int64)


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, same (digest of the set), bands: for each row."""
    def run(batches):
        for batch in batches:
            counts, digests, keys = [], [], []
            for text in batch.column(1):
                codes = shingle_set(text.as_py())
                counts.append(len(codes))
                digests.append(xxhash.xxh3_128_hexdigest(codes.tobytes()) if len(codes) else None)
                keys.append(band_keys(signature(codes, BANDS * ROWS), BANDS, ROWS) if len(codes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "same", "bands"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, same string, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, codes) of the wanted (node, least, same): read again from the documents."""
    def run(batches):
        for batch in batches:
            keep, sets = [], []
            for i, (text, same) in enumerate(zip(batch.column(1), batch.column(2))):
                codes = shingle_set(text.as_py())
                if xxhash.xxh3_128_hexdigest(codes.tobytes()) == same.as_py():
                    keep.append(i)
                    sets.append(codes.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sets, pa.list_(pa.int64()))],
                names=["node", "codes"])

    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("least"))
    return rows.select("node", "text", "same").mapInArrow(run, "node bigint, codes array<bigint>")


def _linked(both, size_a, size_b):
    """100 * intersection >= PERCENT * union."""
    return 100 * both >= PERCENT * (size_a + size_b - both)


def _compare(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of different components, as far as they join components, of one group."""
    node, role = rows.column("node").to_numpy(), rows.column("role").to_numpy()
    component = rows.column("component").to_numpy().copy()
    lists = rows.column("codes").combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    universe, ids = np.unique(lists.values.to_numpy()[offsets[0]:offsets[-1]], return_inverse=True)
    offsets = offsets - offsets[0]
    sizes, mark = np.diff(offsets), np.zeros(len(universe), np.int64)
    left, right = [], []
    for i in np.flatnonzero(role == 1).tolist():
        own = ids[offsets[i]:offsets[i + 1]]
        other = (role == 0) & (component != component[i]) & (
            100 * np.minimum(sizes, sizes[i]) >= PERCENT * np.maximum(sizes, sizes[i]))
        if not other.any():
            continue
        mark[own] = 1
        shared = np.add.reduceat(mark[ids], offsets[:-1])
        mark[own] = 0
        for j in np.flatnonzero(other & _linked(shared, sizes, sizes[i])).tolist():
            if component[j] != component[i]:
                left.append(node[i])
                right.append(node[j])
                component[component == component[j]] = component[i]
    return np.array(left, np.int64), np.array(right, np.int64)


def _block_links(members: DataFrame) -> DataFrame:
    def run(batches):
        for rows in whole_groups(batches, "bucket", "pair"):
            key, pair = rows.column("bucket").to_numpy(), rows.column("pair").to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
                left, right = _compare(rows.slice(a, z - a))
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])

    return members.mapInArrow(run, "a bigint, b bigint")


def near_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, kept, same; a row for each row.

    same: digest of the shingle set (null without shingles)."""
    hashed = written(_hashed(docs), "minhash/hashed")
    reps = written(hashed.where("same IS NOT NULL AND doc_id IS NOT NULL").groupBy("same")
                   .agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "minhash/reps")
    keys = reps.select("node", F.explode("bands").alias("bucket"))
    pivots = keys.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
    shared = written(keys.join(pivots, "bucket").select("bucket", "node", "pivot"), "minhash/shared")
    wanted = shared.select("node").distinct().join(reps.select("node", "least", "same"), "node")
    sets = written(_sets(docs, wanted).dropDuplicates(["node"]), "minhash/sets")

    pairs = shared.where("node <> pivot").select("node", "pivot").distinct()
    mine = sets.select(F.col("node").alias("x"), F.col("codes").alias("own"))
    theirs = sets.select(F.col("node").alias("y"), F.col("codes").alias("others"))
    both = F.size(F.array_intersect("own", "others"))
    links = (pairs.join(mine, F.col("node") == F.col("x")).join(theirs, F.col("pivot") == F.col("y"))
             .where(_linked(both, F.size("own"), F.size("others")))
             .select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    found = written(connected_components(links), "minhash/first")

    placed = (shared.join(found.withColumnRenamed("node", "f"), F.col("node") == F.col("f"), "left")
              .select("bucket", "node", F.coalesce("component", "node").alias("component")))
    code = F.xxhash64("node").cast("decimal(38,0)")
    parts = placed.groupBy("bucket", "component").agg(
        F.count("*").alias("c"), F.sum(code).alias("who"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("too"))
    open_buckets = (parts.groupBy("bucket")
                    .agg(F.count("*").alias("k"), F.sum("c").alias("n"), F.sum("who").alias("who"),
                         F.bit_xor("too").alias("too"), F.max(F.struct("c", "component")).alias("main"))
                    .where("k > 1").groupBy("n", "who", "too")
                    .agg(F.min(F.struct("bucket", "main")).alias("b"))
                    .select("b.bucket", "n", F.col("b.main.c").alias("c"), F.col("b.main.component").alias("main")))
    blocks = lambda rows: F.ceil(rows / BLOCK).cast("long")
    within = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    of = lambda n, key: F.pmod(F.xxhash64(F.lit(key), "node"), F.col(n))
    cut = (placed.join(open_buckets, "bucket").withColumn("all_blocks", blocks(F.col("n")))
           .withColumn("few_blocks", blocks(F.col("n") - F.col("c"))))
    everyone = cut.select("bucket", "node", "component", F.lit(0).alias("role"), of("all_blocks", SEED).alias("i"),
                          F.explode(within("few_blocks")).alias("j"))
    others = cut.where("component <> main").select(
        "bucket", "node", "component", F.lit(1).alias("role"), F.explode(within("all_blocks")).alias("i"),
        of("few_blocks", SEED + 1).alias("j"))
    members = (everyone.unionByName(others).withColumn("pair", F.col("i") * (1 << 31) + F.col("j"))
               .select("bucket", "pair", "role", "node", "component").join(sets, "node")
               .repartition("bucket", "pair").sortWithinPartitions("bucket", "pair", "node"))
    late = written(_block_links(members), "minhash/late")
    if not late.isEmpty():
        first = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = connected_components(first.unionByName(late))
    named = found.join(reps.select(F.col("node").alias("r"), "least", "same"), F.col("node") == F.col("r"))
    least = named.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("id"))
    of_set = (reps.select(F.col("same").alias("s"), F.col("node").alias("r"), "least")
              .join(named.join(least, F.col("component") == F.col("c")).select("node", "id"),
                    F.col("r") == F.col("node"), "left")
              .select("s", F.coalesce("id", "least").alias("id")))
    linked = F.when(F.col("doc_id").isNotNull(), F.col("same")) == F.col("s")
    return (hashed.join(of_set, linked, "left")
            .select("doc_id", "n_shingles", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("id")), "doc_id").alias("component_id"), "same")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", "kept", "same"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (its columns) that stay: of linked documents the one of the least id, of
    rows equal in id and text one; documents without an id or without shingles all stay."""
    kept = near_documents(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    stay = docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.unionByName(docs.where("doc_id IS NULL"))
