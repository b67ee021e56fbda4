"""Operator 1: embedding near-dedup.

Random-hyperplane sign hashing in several tables finds candidates, every
candidate pair is verified by its exact cosine in double precision, and the
links' connected components are found in a distributed way.

* Equal vectors of a label are one representative with a weight, so a group
  of copies costs one row.
* The bits of a signature grow with the logarithm of the largest label group,
  so a bucket of unrelated vectors stays small; the number of tables follows
  from the bits so that a pair at the threshold is missed with probability
  ``MISS`` at most (``parameters``).
* Only vectors that share a bucket are carried on.  A bucket is cut into blocks
  of ``BLOCK`` vectors by a hash of the id, and each pair of blocks is a group
  of its own: a bucket of any size is compared whole, in bounded groups.
* A pair is counted in the first table where its signatures agree, so links
  are counted once.  Groups emit a count and a parent per vector, never pairs.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, rows without a label and rows without an id have no
links and are their own component; vectors of different length don't link;
rows repeated under one id are vectors of their own in ``n_links``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slots, whole_groups, written
from .components import connected_components

THRESHOLD, MISS, BLOCK, SEED = 0.98, 1e-7, 1024, 77


def parameters(largest_group: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for label groups of up to this many vectors."""
    bits = min(40, max(10, math.ceil(math.log2(max(2, largest_group))) + 2))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(lists), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _signatures(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """``reps`` with sigs array<bigint>: a signature of each table."""
    def run(batches):
        planes = {}
        for batch in batches:
            lengths = np.diff(batch.column("vector").offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))
                signs = (_matrix(part.column("vector")) @ planes[dim] >= 0).reshape(len(part), tables, bits)
                sigs = signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))
                offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * tables)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(sigs.reshape(-1)))],
                    names=[*part.schema.names, "sigs"])

    schema = "rep bigint, label string, dim int, weight bigint, vector array<double>, sigs array<bigint>"
    return reps.mapInArrow(run, schema)


def _small_groups(starts, ends):
    """Row pairs of all groups of rows [start, end), by offset within the group."""
    longest = int((ends - starts).max()) if len(starts) else 0
    for gap in range(1, longest):
        wide = ends - starts > gap
        counts = (ends - starts - gap)[wide]
        left = np.repeat(starts[wide] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        yield left, left + gap


def _verify(rows: pa.Table, threshold: float):
    """Links among rows of whole groups, sorted by group: (rep, links, parent) arrays."""
    dims = rows.column("dim").to_numpy()
    if len(np.unique(dims)) > 1:                     # a group has one length
        parts = [_verify(rows.filter(pa.array(dims == d)), threshold) for d in np.unique(dims)]
        return tuple(np.concatenate(c) for c in zip(*parts))
    unit, tables = _matrix(rows.column("vector").combine_chunks()), rows.column("table").to_numpy()
    sigs = rows.column("sigs").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    rep, weight = rows.column("rep").to_numpy(), rows.column("weight").to_numpy()
    block, pair = rows.column("block").to_numpy(), rows.column("pair").to_numpy()
    key = rows.column("bucket").to_numpy()
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(rows))
    found = []
    big = ends - starts > 24
    for left, right in _small_groups(starts[~big], ends[~big]):
        near = np.einsum("ij,ij->i", unit[left], unit[right]) >= threshold
        found.append((left[near], right[near]))
    for a, z in zip(starts[big].tolist(), ends[big].tolist()):
        for low in range(a, z, 256):
            x, y = np.nonzero(unit[low:min(low + 256, z)] @ unit[a:z].T >= threshold - 1e-9)
            x, y = x + low, y + a
            x, y = x[x < y], y[x < y]
            near = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            found.append((x[near], y[near]))
    left, right = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int),) * 2
    # blocks: within one, or across the two of the group
    ok = (block[left] != block[right]) | (pair[left] == block[left] * (1 << 31) + block[left])
    left, right = left[ok], right[ok]
    table = tables[left]
    earlier = (sigs[left] == sigs[right]) & (np.arange(sigs.shape[1]) < table[:, None])
    first = ~earlier.any(axis=1)
    left, right = left[first], right[first]
    links = np.bincount(left, weight[right], len(rows)) + np.bincount(right, weight[left], len(rows))
    parent = rep.copy()
    while len(left):
        low = np.minimum(parent[left], parent[right])
        before = parent.copy()
        np.minimum.at(parent, left, low)
        np.minimum.at(parent, right, low)
        if (before == parent).all():
            break
    linked = links > 0
    return rep[linked], links[linked].astype(np.int64), parent[linked]


def _links(members: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, parent) for each group of (bucket, pair): whole groups, batch by batch."""
    def run(batches):
        for rows in whole_groups(batches, "bucket", "pair"):
            rep, links, parent = _verify(rows, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links), pa.array(parent)],
                                             names=["rep", "links", "parent"])

    return members.mapInArrow(run, "rep bigint, links bigint, parent bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) -> vec_id, n_links, component_id, kept, label."""
    spark = vectors.sparkSession
    vector = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    # a null vector or label makes this null: not usable
    usable = F.coalesce((F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
                        & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector"),
                          usable.alias("usable"))
    rows = rows.withColumn("same", F.when(F.col("usable"), F.sha2(
        F.concat_ws(",", F.col("vector").cast("array<string>")), 256)))
    good = rows.where("usable")
    reps = (good.groupBy("label", "same")
            .agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
            .withColumn("rep", F.monotonically_increasing_id()))     # written below, so it stays
    reps = written(reps.select("rep", "least", "label", F.size("vector").alias("dim"), "weight", "vector", "same"),
                   "embeddings/reps")
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = parameters(largest, threshold)
    # the table is small beside its CPU time: dealt to all cores
    dealt = reps.drop("same", "least").repartition(slots(spark), F.col("rep"))
    hashed = written(_signatures(dealt, bits, tables), "embeddings/hashed")
    keys = hashed.select("rep", "label", "dim", F.posexplode("sigs").alias("table", "sig"))
    bucket = F.xxhash64("label", "dim", "table", "sig")
    keys = keys.select("rep", "table", bucket.alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64(F.lit(SEED), "rep"), "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    members = (keys.join(shared, "bucket").withColumn("blocks", blocks).withColumn("block", own)
               .withColumn("other", other)
               .withColumn("pair", F.least("block", "other") * (1 << 31) + F.greatest("block", "other"))
               .select("bucket", "pair", "block", "table", "rep"))
    members = (members.join(hashed.select("rep", "dim", "weight", "vector", "sigs"), "rep")
               .repartition("bucket", "pair").sortWithinPartitions("bucket", "pair"))
    links = written(_links(members, threshold), "embeddings/links")
    edges = links.where("rep <> parent").select(F.col("rep").alias("a"), F.col("parent").alias("b"))
    found = connected_components(edges)
    named = found.join(reps.select("rep", "least"), F.col("node") == F.col("rep"))
    named = named.join(named.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("id")),
                       F.col("component") == F.col("c")).select("node", "id")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    facts = (reps.select("rep", "least", F.col("label").alias("l"), F.col("same").alias("s"), "weight")
             .join(counted, "rep", "left").join(named, F.col("rep") == F.col("node"), "left")
             .select("l", "s", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("id", "least").alias("component")))
    return (rows.join(facts, (F.col("label") == F.col("l")) & (F.col("same") == F.col("s")), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").cast("long").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
