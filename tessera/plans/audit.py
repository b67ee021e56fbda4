"""Audit jobs of the mart's row-level re-statement (FLT-3, FLT-4, JOIN-7,
AGG-2, AGG-3, PRT-1, STR-5).

The reference collects card numbers to the driver, broadcasts the array and
tests every row in a closure.  Here membership is a join against the distinct
card numbers (no driver round trip, NULL never matches), and both counts come
from one aggregate over one pass.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import checkpointed, persisted
from . import mart

# Fixed value: the head-office branch the reference looks up.
DEFAULT_LOOKUP_BRANCH = "01001022"


def rule_audit_counts(fee_txn: DataFrame, cards: DataFrame) -> DataFrame:
    """FLT-4, JOIN-7, AGG-2, AGG-3.  One row: distinct transactions, and how
    many of them pass the rules and belong to a known card.

    Counted in two levels over one scan.  The whole-row distinct is the only
    exchange of transactions; it keeps map-side partial aggregation, so runs
    of identical rows collapse before it.  Its rows become one row per card
    (rows, and rows that pass), combined map-side, so that a card with any share
    of the transactions is at most one row a task.  Those rows meet the known
    cards, and each count is one number per partition.
    """
    per_card = (fee_txn.distinct().groupBy("PAN")
                .agg(F.count(F.lit(1)).alias("n"), F.count_if(rules.passes_rules()).alias("n_passing")))
    known = mart.known_cards(cards).distinct().withColumn("known", F.lit(True))
    return (per_card.join(known, per_card["PAN"] == known["CRD_NO"], "left")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                 F.coalesce(F.sum(F.when(F.col("known"), F.col("n_passing"))), F.lit(0)).alias("n_matched")))


def branch_lookup(branches: DataFrame, org_id: str = DEFAULT_LOOKUP_BRANCH) -> DataFrame:
    """FLT-3: distinct branch rows for one branch id (filter pushed to the scan)."""
    return mart.branch_dim(branches.where(F.col("org_id") == org_id))


def upper_org_by_partition(branches: DataFrame, keep: bool = True) -> DataFrame:
    """PRT-1, STR-5, MAT-2.  Each distinct branch's parent id tagged with the
    partition holding it, as ``<partition>_<parent id>`` (a NULL parent reads
    ``null``).

    The numbers depend on the physical layout, so with ``keep`` the tagged
    rows are persisted (memory, spilling to disk): every later action sees the
    same tags.  The caller ``unpersist()``s it when done."""
    tagged = mart.branch_dim(branches).select(
        F.concat(F.spark_partition_id().cast("string"), F.lit("_"),
                 F.coalesce(F.col("org_upperid"), F.lit("null"))).alias("TAG"))
    return tagged.persist(StorageLevel.MEMORY_AND_DISK) if keep else tagged


def upper_org_tag_facts(branches: DataFrame) -> DataFrame:
    """MAT-1, MAT-2, PRT-1, STR-5.  Per parent id: its tagged rows, and whether each tag reads
    ``<number below the partition count>_<parent id>``; what no layout changes.

    The tags are cached for the two passes over them and released before the facts are returned."""
    with persisted(upper_org_by_partition(branches, keep=False)) as tags:
        parts = tags.rdd.getNumPartitions()
        number = F.regexp_extract("TAG", r"\A([0-9]+)_", 1)
        good = (number != "") & (number.try_cast("int") < F.lit(max(1, parts)))
        return checkpointed(tags.select(F.regexp_replace("TAG", r"\A[0-9]+_", "").alias("org_upperid"),
                                        F.coalesce(good, F.lit(False)).alias("well_formed"))
                            .groupBy("org_upperid").agg(F.count(F.lit(1)).alias("n_rows"),
                                                        F.bool_and("well_formed").alias("well_formed")))
