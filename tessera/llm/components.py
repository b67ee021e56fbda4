"""Distributed connected components by alternating large-star and small-star.

Edges stay a distributed table; each round is two aggregations and two joins
on node ids, written to the shared folder.  A hot node is a single row on the
aggregated side of its join, so Spark can split its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _facts(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id reachable, for every node of an edge (a, b long).

    Edges with a null end and loops link nothing; an empty table gives an empty result."""
    star = written(edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
                   .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "components/edges")
    before = _facts(star)
    while before[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(least, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.least("m", F.col("u")).alias("v")).distinct())
        large = written(large, "components/large")
        lowest = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = (large.join(lowest, F.col("u") == F.col("k")).where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        star = written(small, "components/small")
        now = _facts(star)
        if now == before:
            break
        before = now
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
