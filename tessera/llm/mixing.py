"""Operator 9: mixing sources to target weights (DataFrame functions only).

A source's target is a number of words.  Whole multiples of the source are
taken as whole passes; the rest is drawn without replacement:

* Documents are dealt to output shards by a keyed hash.  Inside a (source,
  shard) cell they stand in keyed order as one stream of words, cut into
  blocks of ``BLOCK_WORDS`` (only a cell's last block is shorter).
* The source's exact block quota is split among the shards by a
  multivariate-hypergeometric tree: a node with ``FANOUT`` children gives
  each child a hypergeometric share of what is left, so the leaves' quotas
  add up to the source's and are distributed as if the blocks had been drawn
  one by one from the whole source.
* In a cell the quota's blocks of least keyed hash are drawn: disjoint, in
  permuted order.  A cell's threshold hash says which blocks those are, so no
  block list is joined back to the documents.
* Rows of a shard are put in keyed order within the shard.

Cells hold about ``CELL_BLOCKS`` blocks whatever the source's size, so a
source with a third of all rows is many cells.  All random choices are hashes
of the seed and the row's values: reruns agree.

Hypergeometric draws invert the exact distribution around its mode, 10
standard deviations each way, at every size.  A level of the tree has ``FANOUT``
times the nodes of the one above and a fourth of its deviations, so the steps of
all levels together are a small multiple of the cells' own.

A part of a document is a run of adjacent drawn blocks, cut out of the text with
its own white space; runs that are apart are documents of their own.

Defined results: null text has size 0 and is never taken; a null source is a
source of its own, last in order; rows with equal values are separate rows, and
rows of one id and size stand by a hash of their text; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, apart, written

#: Parameters: weights by source order (repeating), share of all words to take,
#: largest multiple of a source.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Words of a block, blocks of a cell, children of a tree node.
BLOCK_WORDS, CELL_BLOCKS, FANOUT = 64, 4096, 16
SEED = 20_011


#: Fixed value: a word with the white space before it.
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with size, and tie: a hash of the text that orders rows of one id and size."""
    return (docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
            .withColumn("tie", F.xxhash64("text")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target): the water level at which the capped shares add up to the
    budget.  Sources stand by code point, null last; one row per source is sorted in one task."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most)))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    budget = F.sum("source_size").over(everything) * F.lit(share)
    level = per.withColumn("level", (budget - before) / left)
    level = level.withColumn("level", F.max("level").over(everything))
    return level.select("source", "source_size",
                        F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _uniform(*parts: Column) -> Column:
    """A keyed number in (0, 1)."""
    bits = F.xxhash64(F.lit(SEED), *parts).bitwiseAND(F.lit((1 << 52) - 1))
    return (bits.cast("double") + 0.5) / float(1 << 52)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among ``draws`` from good + bad, by a uniform number u."""
    empty = F.array().cast("array<bigint>")
    up = lambda p, x: (p.g - x) * (p.k - x) / ((x + 1) * (p.b - p.k + x + 1))
    down = lambda p, x: x * (p.b - p.k + x) / ((p.g - x + 1) * (p.k - x + 1))

    def steps(a, z, by):
        return F.coalesce(F.when((z - a) * by >= 0, F.sequence(a.cast("long"), z.cast("long"),
                                                              F.lit(by).cast("long"))), empty)

    def mass(p, over, ratio):
        return F.aggregate(over, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("t")),
                           lambda s, x: _let(s.w * ratio(p, x), lambda w: F.struct(
                               w.alias("w"), (s.t + w).alias("t"))), lambda s: s.t)

    def pick(p, goal, over, ratio, start, to):
        """The first value at which the mass, added up from ``start``, reaches the goal."""
        none = F.lit(None).cast("bigint")
        return F.aggregate(
            over, F.struct(F.lit(1.0).alias("w"), start.alias("t"), none.alias("x")),
            lambda s, x: _let(s.w * ratio(p, x), lambda w: F.struct(
                w.alias("w"), (s.t + w).alias("t"),
                F.coalesce(s.x, F.when(s.t + w >= goal, x + to)).alias("x"))),
            lambda s: s.x)

    def exact(p):
        reach = F.ceil(p.sigma * 10).cast("double") + 8
        top, low = F.least(p.hi, p.mode + reach), F.greatest(p.lo, p.mode - reach)
        ups, downs = steps(p.mode, top - 1, 1), steps(p.mode, low + 1, -1)
        masses = F.struct(mass(p, ups, up).alias("above"), mass(p, downs, down).alias("below"))
        return _let(masses, lambda m: _let(u * (m.above + m.below + 1), lambda goal: F.when(
            goal <= 1, p.mode.cast("long")).otherwise(F.coalesce(
                pick(p, goal, ups, up, F.lit(1.0), 1), pick(p, goal, downs, down, m.above + 1, -1),
                p.mode.cast("long")))))

    def spread(p):
        n = p.g + p.b
        var = F.when(n > 1, p.k * (p.g / n) * (p.b / n) * (n - p.k) / (n - 1)).otherwise(0.0)
        mode = F.floor((p.k + 1) * (p.g + 1) / (n + 2)).cast("double")
        return F.struct(p.g.alias("g"), p.b.alias("b"), p.k.alias("k"), p.lo.alias("lo"), p.hi.alias("hi"),
                        F.least(p.hi, F.greatest(p.lo, mode)).alias("mode"),
                        F.sqrt(F.greatest(var, F.lit(0.0))).alias("sigma"))

    g, b, k = good.cast("double"), bad.cast("double"), draws.cast("double")
    given = F.struct(g.alias("g"), b.alias("b"), k.alias("k"), F.greatest(F.lit(0.0), k - b).alias("lo"),
                     F.least(k, g).alias("hi"))
    return _let(given, lambda p: _let(spread(p), exact))


def _split(nodes: DataFrame, level: int) -> DataFrame:
    """One level down: each node's quota among its children (source, node, caps, quota)."""
    def child(state, cap):
        u = _uniform(F.col("source"), F.col("node"), F.lit(level), F.size(state.got))
        got = hypergeometric(cap, state.rest - cap, state.quota, u)
        return _let(got, lambda x: F.struct(
            (state.rest - cap).alias("rest"), (state.quota - x).alias("quota"),
            F.concat(state.got, F.array(x)).alias("got")))

    start = F.struct(F.aggregate("caps", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("rest"),
                     F.col("quota").alias("quota"), F.array().cast("array<bigint>").alias("got"))
    got = F.aggregate("caps", start, child, lambda s: s.got)
    return (nodes.withColumn("got", got)
            .select("source", F.posexplode(F.arrays_zip("kids", "got")).alias("at", "kid"))
            .select("source", F.col("kid.kids").alias("node"), F.col("kid.got").alias("quota")))


def cell_quotas(cells: DataFrame, quotas: DataFrame, depth: int) -> DataFrame:
    """(source, shard, quota): the source's block quota split down the tree to its shards.

    cells: (source, shard, n_blocks); quotas: (source, quota)."""
    nodes = quotas.select("source", F.lit(0).cast("bigint").alias("node"), "quota")
    for level in range(depth):
        here = FANOUT ** (depth - level - 1)
        kids = (cells.groupBy("source", F.floor(F.col("shard") / here).cast("bigint").alias("kid"))
                .agg(F.sum("n_blocks").alias("cap"))
                .groupBy("source", F.floor(F.col("kid") / FANOUT).cast("bigint").alias("node"))
                .agg(F.array_sort(F.collect_list(F.struct("kid", "cap"))).alias("k"))
                .select("source", "node", F.col("k.kid").alias("kids"), F.col("k.cap").alias("caps")))
        same = kids["source"].eqNullSafe(nodes["source"]) & (kids["node"] == nodes["node"])
        # written: a level's draws are long expressions, which later stages need not be planned with
        nodes = written(_split(kids.join(nodes, same).select(kids["source"], kids["node"], "kids", "caps", "quota"),
                               level), "mixing/nodes")
    return nodes.withColumnRenamed("node", "shard")


def depth_for(words: int) -> int:
    """Levels of the tree so that a shard holds about CELL_BLOCKS blocks."""
    cells = max(1, math.ceil(words / (BLOCK_WORDS * CELL_BLOCKS)))
    return max(1, math.ceil(math.log(cells, FANOUT))) if cells > 1 else 1


def mix(sized: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``sized`` (doc_id, source, size, ...) with source_size, target, whole (whole passes), drawn
    (array of the drawn runs: from, n words), taken, and shard and place (the shuffled order).

    sizes: the same rows' (doc_id, source, size) where they are cheaper to read."""
    sizes = sizes if sizes is not None else sized
    targets = source_targets(sizes)
    words = sizes.agg(F.sum("size")).first()[0] or 0
    depth = depth_for(words)
    shards = FANOUT ** depth
    shard = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size"), F.lit(shards))
    cells = written(sizes.where("size > 0").groupBy("source", shard.alias("shard"))
                    .agg(F.ceil(F.sum("size") / BLOCK_WORDS).cast("bigint").alias("n_blocks")), "mixing/cells")
    wanted = F.round("target").cast("bigint")
    plan = (targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size")))
                               .otherwise(0).cast("bigint"))
            .withColumn("rest", wanted - F.col("whole") * F.col("source_size")))
    plan = written(plan, "mixing/plan")
    room = cells.groupBy("source").agg(F.sum("n_blocks").alias("n")).withColumnRenamed("source", "s")
    # the share of the source's blocks that holds the rest of its words
    quotas = (plan.join(room, F.col("source").eqNullSafe(F.col("s")))
              .select("source", F.least("n", F.round(F.col("rest") / F.col("source_size") * F.col("n"))
                                        .cast("bigint")).alias("quota")))
    quotas = cell_quotas(cells, quotas, depth).withColumnRenamed("source", "s").withColumnRenamed("shard", "h")
    key = lambda source, at, block: F.xxhash64(F.lit(SEED + 1), source, at, block)
    c, q = cells.alias("c"), quotas.alias("q")
    keys = F.array_sort(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1),
                                    lambda x: key(F.col("c.source"), F.col("c.shard"), x)))
    drawn = written(c.join(q, F.col("c.source").eqNullSafe(F.col("q.s")) & (F.col("c.shard") == F.col("q.h")))
             .where("quota > 0")
             .select(F.col("c.source").alias("s"), F.col("c.shard").alias("h"),
                     F.element_at(keys, F.col("quota").cast("int")).alias("limit_key")), "mixing/drawn")
    plan = plan.select(F.col("source").alias("p"), "source_size", "target", "whole")
    stream = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(SEED + 2), "doc_id"),
                                                           "doc_id", "size", "tie")
    placed = (sized.withColumn("shard", shard)
              .withColumn("upto", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start", F.col("upto") - F.col("size")))
    joined = (placed.join(drawn, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")), "left")
              .join(plan, F.col("source").eqNullSafe(F.col("p"))))
    touched = F.when((F.col("size") > 0) & F.col("limit_key").isNotNull(),
                     F.sequence(F.floor(F.col("start") / BLOCK_WORDS),
                                F.floor((F.col("upto") - 1) / BLOCK_WORDS)))
    hit = F.filter(touched, lambda x: key(F.col("source"), F.col("shard"), x) <= F.col("limit_key"))
    joined = joined.withColumn("hit", hit)
    # adjacent blocks are one run: from a block without a drawn one before it to one without a drawn one after it
    edge = lambda step: F.filter("hit", lambda x, i: F.coalesce(
        F.get("hit", i + step) != x + step, F.lit(True)))
    runs = F.transform(F.arrays_zip(edge(-1).alias("a"), edge(1).alias("b")), lambda r: _let(
        F.greatest(F.col("start"), r.a * BLOCK_WORDS), lambda begin: F.struct(
            (begin - F.col("start")).alias("from"),
            (F.least(F.col("upto"), (r.b + 1) * BLOCK_WORDS) - begin).alias("n"))))
    return (joined.withColumn("drawn", runs)
            .withColumn("taken", F.col("whole") * F.col("size")
                        + F.coalesce(F.aggregate("drawn", F.lit(0).cast("bigint"), lambda a, r: a + r.n),
                                     F.lit(0)))
            .withColumn("place", F.xxhash64(F.lit(SEED + 3), "doc_id", "size"))
            .drop("s", "h", "p", "limit_key", "upto", "start", "hit", "tie"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents (the columns of ``docs``): a document once per whole pass, and each of its drawn
    runs, as it stands in the text (all of the words: the whole text)."""
    docs, back = apart(docs, "doc_id", "source", "text", "n_chars")
    sizes = written(with_size(docs.select("doc_id", "source", "text")).drop("text"), "mixing/sizes")
    out = mix(with_size(docs), sizes)
    words = F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))
    part_size = F.col("taken") - F.col("whole") * F.col("size")
    parts = _let(words, lambda w: F.transform("drawn", lambda r: F.regexp_replace(F.array_join(
        F.slice(w, (r["from"] + 1).cast("int"), r["n"].cast("int")), ""), r"\A[\x20\x09-\x0D]+", "")))
    # the parts' words are cut out only where a part is taken
    texts = F.concat(F.array_repeat(F.col("text"), F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("int")),
                     F.when(part_size == 0, F.array().cast("array<string>"))
                     .when(part_size == F.col("size"), F.array("text")).otherwise(parts))
    copies = out.withColumn("copy", F.explode(texts)).withColumn("text", F.col("copy"))
    if "n_chars" in docs.columns:
        copies = copies.withColumn("n_chars", F.length("text").cast("long"))
    return copies.select(*back)
