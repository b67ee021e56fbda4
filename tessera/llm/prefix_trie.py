"""Operator 12: prefix trie of conversations, totals by depth-band rollup.

``rebuilt`` gives every conversation the first turns of another one; ``trie``
takes any table of (conv, depth, digest, chars) and returns its nodes: a node is a distinct sequence
of first turns, known by its smallest member and its depth.

* Order.  Narrow rows (digests, never texts) are range-partitioned by
  (conversation, turn, ...) down to single rows, so a conversation of any length
  spans as many tasks as it needs; places are counted within a partition and
  shifted by the rows of its conversation in earlier ones.
* Identity.  A turn at a depth has four 31-bit hashes of (depth, SHA-256 of
  role and text); a prefix is known by their sums.  Sums are taken in blocks
  of ``BLOCK`` depths, then over blocks, so neither a round a turn nor a task a
  conversation is needed.
* Totals.  The smallest member of a node is also that of every node below it
  on its path, so each node stands once, on its own member's path.  Depths are
  cut into bands of ``BAND``.  A node's values go to its ancestors in its band
  only, as a sum from below along its path, and rows of one node are added up.
  The totals of band roots are completed by the same rollup over the trie of
  band roots, whose depth is ``BAND`` times smaller; a completed band root then
  counts in the band above it.  So there are log(depth) to the base ``BAND``
  levels, and a row meets at most ``BAND`` ancestors in each.
* Ends.  A node's ending members are joined to text in pieces of a range of
  ``PIECE`` ids, and a task hashes a node's pieces one after the other in order.

Defined results: rows without ``conv_id`` belong to no conversation; turns
stand by turn number, null first, rows of one number by role, then by SHA-256
of the text; repeated rows are turns of their own; a null role or text is
empty; other columns are ignored; an empty table has no conversation, so no
root.  ``%`` takes the sign of its left side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, slots, written

#: Parameter: depths of a band; each node's values go to its ancestors within the band.
BAND = 16
#: Parameter: depths over which one window sums the hashes of a path.
BLOCK = 256
#: Parameter: ids of a node's ending members that one row of text may hold.
PIECE = 4096
#: Conversations that share a donor; exclusive bound of the borrowed turns.
DONOR_EVERY, MOST_BORROWED = 100, 6

LANES = ("s0", "s1", "s2", "s3")
KEY = ("k0", "k1")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv, place, digest, chars): every turn with its place (from 0) in its conversation."""
    spark = turns.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = F.sha2(text, 256)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        body.alias("body"), F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("body"), F.col("row")]
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("body")), 256)), 1, 16)
    schema = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("seq", pa.int64()), ("digest", pa.binary()),
                        ("chars", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            conv = batch.column("conv").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            seq = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if conv[0] == last:
                seq[:starts[1] if len(starts) > 1 else len(conv)] += done
            last, done = conv[-1], int(seq[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part, np.int32)), batch.column("conv"),
                                              pa.array(seq), batch.column("digest"), batch.column("chars")], schema=schema)

    sorted_rows = rows.repartitionByRange(slots(spark), *order).sortWithinPartitions(*order)
    counted = written(sorted_rows.select("conv", digest.alias("digest"), "chars")
                      .mapInArrow(count, "part int, conv long, seq long, digest binary, chars long"), "trie/turns")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (counted.groupBy("part", "conv").agg(F.count("*").alias("n"))
              .select("part", "conv", F.sum("n").over(before).alias("shift")).where("shift > 0"))
    # only the first conversation of a partition goes on from an earlier one: at most a row a partition
    return (counted.join(F.broadcast(shifts), ["part", "conv"], "left")
            .select("conv", (F.col("seq") + F.coalesce("shift", F.lit(0))).alias("place"), "digest", "chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, chars) of the rebuilt conversations, and (conv) of all of them, turnless ones too.

    Conversation c takes the first h turns of c - c % 100, then its own after its first h; h = crc32(c) % 6."""
    own = ordered_turns(turns)
    donor = (F.col("conv") - F.col("conv") % DONOR_EVERY).alias("donor")
    h = crc_mod(F.col("conv"), MOST_BORROWED)
    convs = own.select("conv").distinct()
    heads = (own.where((F.col("conv") % DONOR_EVERY == 0) & (F.col("place") < MOST_BORROWED - 1))
             .withColumnRenamed("conv", "donor"))
    held = heads.groupBy("donor").agg(F.count("*").alias("held"))
    borrowed = (convs.select("conv", donor, h.alias("h")).join(heads, "donor").where("place < h")
                .select("conv", (F.col("place") + 1).alias("depth"), "digest", "chars"))
    kept = (own.select("*", donor, h.alias("h")).where("place >= h").join(held, "donor", "left")
            .select("conv", (F.col("place") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0))) + 1).alias("depth"),
                    "digest", "chars"))
    return borrowed.unionByName(kept), convs


def prefixes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, k0, k1, p0, p1, chars): the prefix that each conversation has at each depth from 0, by the
    128 bits of its key and of its parent's."""
    low = 0x7FFFFFFF
    hashes = [F.xxhash64(F.lit(j), "depth", "digest") for j in (0, 1)]
    lanes = [x for h in hashes for x in (h.bitwiseAND(F.lit(low)), F.shiftrightunsigned(h, 33))]
    block = F.floor((F.col("depth") - 1) / BLOCK).cast("long")
    hashed = rows.select("conv", "depth", "chars", block.alias("block"), *[x.alias(f"x{i}") for i, x in enumerate(lanes)])
    within = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = hashed.select("conv", "depth", "chars", "block", "x0", "x1", "x2", "x3",
                         *[F.sum(f"x{i}").over(within).alias(s) for i, s in enumerate(LANES)])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (hashed.groupBy("conv", "block").agg(*[F.sum(f"x{i}").alias(s) for i, s in enumerate(LANES)])
             .select("conv", "block", *[F.sum(s).over(earlier).alias(f"a{i}") for i, s in enumerate(LANES)])
             .where("block > 0"))
    full = sums.join(ahead, ["conv", "block"], "left").select(
        "conv", "depth", "chars", *[f"x{i}" for i in range(4)],
        *[(F.col(s) + F.coalesce(f"a{i}", F.lit(0))).alias(s) for i, s in enumerate(LANES)])
    key = lambda depth, sums: [F.xxhash64(F.lit(j), depth, *sums) for j in (0, 1)]
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), *[k.alias(n) for k, n in zip(key(zero, [zero] * 4), KEY)],
                         *[F.lit(None).cast("long").alias(n) for n in ("p0", "p1")], zero.alias("chars"))
    parent = key(F.col("depth") - 1, [F.col(s) - F.col(f"x{i}") for i, s in enumerate(LANES)])
    return roots.unionByName(full.select(
        "conv", "depth", *[k.alias(n) for k, n in zip(key(F.col("depth"), LANES), KEY)],
        *[k.alias(n) for k, n in zip(parent, ("p0", "p1"))], "chars"))


def subtree_totals(paths: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """(node, depth, values): each node's values summed over its subtree.

    ``paths`` has (conv, depth, node, values): the node that each conversation has at each depth; a node's
    values stand on the path of the conversation of its own name (conv = node) and are 0 elsewhere."""
    spark = paths.sparkSession
    deepest = paths.agg(F.max("depth")).first()[0] or 0
    below = Window.partitionBy("conv", "band").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)

    def rolled(rows: DataFrame) -> DataFrame:
        """Each row's values go to the rows above it in its conversation and band, then to their nodes."""
        sums = rows.select("node", "depth", "band", *[F.sum(v).over(below).alias(v) for v in values])
        some = " OR ".join(f"{v} <> 0" for v in values)
        return sums.where(f"node IS NOT NULL AND ({some})").groupBy("node", "depth").agg(
            *[F.sum(v).alias(v) for v in values])

    banded = paths.withColumn("band", F.floor(F.col("depth") / BAND).cast("long"))
    if deepest < BAND:
        return rolled(banded)
    in_band = written(rolled(banded).where(F.col("depth") % BAND == 0), "trie/band_roots")
    up = F.col("depth") / BAND
    border = (paths.where(F.col("depth") % BAND == 0).select("conv", "node", up.cast("long").alias("depth"))
              .join(in_band.select(F.col("node").alias("conv"), up.cast("long").alias("depth"), *values),
                    ["conv", "depth"], "left")
              .select("conv", "depth", "node", *[F.coalesce(v, F.lit(0)).alias(v) for v in values]))
    completed = subtree_totals(written(border, "trie/borders"), values)
    # a completed band root counts in the band above, on its own member's path, and is no node of that band
    roots = completed.where("depth > 0").select(
        F.col("node").alias("conv"), (F.col("depth") * BAND).alias("depth"), F.lit(None).cast("long").alias("node"),
        *values, (F.col("depth") - 1).alias("band"))
    return rolled(banded.unionByName(roots))


def _digests(ends: DataFrame) -> DataFrame:
    """(k0, k1, ends_sha256) of (k0, k1, conv): the conversations that end at a node, ascending and comma-joined."""
    pieces = (ends.groupBy(*KEY, F.floor(F.col("conv") / PIECE).cast("long").alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids")))
    schema = pa.schema([("k0", pa.int64()), ("k1", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k0, k1, ids in zip(*(batch.column(c).to_pylist() for c in ("k0", "k1", "ids"))):
                if (k0, k1) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k0, k1), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, state.hexdigest()), schema)],
                                             schema=schema)

    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
            .mapInArrow(digest, "k0 long, k1 long, ends_sha256 string"))


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the conversations ``convs`` with turns ``rows`` (conv, depth from 1, digest, chars)."""
    known = written(prefixes(rows, convs), "trie/prefixes")
    nodes = written(known.groupBy("depth", *KEY).agg(
        F.min("conv").alias("node"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        F.min("p0").alias("p0"), F.min("p1").alias("p1")), "trie/nodes")
    parents = nodes.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("node").alias("parent"))
    family = written(nodes.join(parents, ["p0", "p1"], "left").select(
        "node", "depth", *KEY, "n_convs", "chars", "parent"), "trie/family")
    children = (family.where("parent IS NOT NULL")
                .groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count("*").alias("n_children")))
    family = written(family.join(children, ["node", "depth"], "left").select(
        "node", "depth", *KEY, "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie/counted")
    own = F.col("conv") == F.col("node")
    paths = written(known.select("conv", "depth", *KEY).join(family.select(*KEY, "node", "n_children", "saved"), list(KEY))
                    .select("conv", "depth", "node",
                            F.when(own & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("n_leaves"),
                            F.when(own, F.col("saved")).otherwise(0).alias("saved_tokens")), "trie/paths")
    totals = subtree_totals(paths, ("n_leaves", "saved_tokens"))
    last = known.groupBy("conv").agg(F.max_by(F.struct(*KEY), "depth").alias("at")).select("conv", "at.k0", "at.k1")
    return (family.join(totals, ["node", "depth"]).join(_digests(last), list(KEY), "left")
            .select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    rows, convs = rebuilt(turns)
    return trie(rows, convs)


#: DuckDB SQL of the registered query; crc32 is folded over the decimal's characters, eight shifts a character.
TRIE_SQL = """
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     sha256(coalesce(text, ''))) - 1 AS place
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c - c % 100 AS donor, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
            flatten(list_transform(string_split(c::VARCHAR, ''),
                                   lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 6 AS h
        FROM t),
r AS (SELECT ids.c, place + 1 AS d, role, text FROM ids JOIN t ON t.c = donor AND place < h
      UNION ALL
      SELECT ids.c, place - h + 1 + (SELECT count(*) FROM t x WHERE x.c = donor AND x.place < h), role, text
      FROM ids JOIN t ON t.c = ids.c AND place >= h),
p AS (SELECT c, 0 AS d, '' AS path, 0 AS chars FROM ids
      UNION ALL
      SELECT c, d, string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
                   OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING), length(text) FROM r),
q AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS parent, max(d) OVER (PARTITION BY c) AS len FROM p),
n AS (SELECT path, d, min(c) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, max(chars) AS chars,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '') AS ends FROM q GROUP BY path, d),
m AS (SELECT n.*, (SELECT count(*) FROM n k WHERE k.parent = n.path AND k.d = n.d + 1) AS n_children FROM n),
s AS (SELECT p.path, p.d, count(*) FILTER (m.n_children = 0) AS n_leaves,
             sum((m.n_convs - 1) * m.chars)::BIGINT AS saved_tokens
      FROM m JOIN p ON p.c = m.conv_id AND p.d <= m.d GROUP BY p.path, p.d)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       s.saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s USING (path, d) LEFT JOIN n u ON u.path = m.parent AND u.d = m.d - 1
"""
