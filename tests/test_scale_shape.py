"""The plan shape of the 100 TB run -- every dimension over its broadcast
bound, no static or adaptive broadcast -- gives the same rows as the small
plan.  At test scale the broadcast paths are always taken otherwise."""

from contextlib import contextmanager

import pytest

from tessera.operators import joins
from tessera.plans import audit, calendar_jobs as cal, mart
from tessera.sources import card_warehouse, read_table

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def at_scale_plan(spark):
    """Dimensions over their bound (max_bytes=0) and broadcast thresholds off."""
    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(mart, "bounded_broadcast",
                   lambda df, max_bytes=0: joins.bounded_broadcast(df, max_bytes=0))
        mp.setattr(mart, "bounded_broadcasts",
                   lambda *dfs, max_bytes=0: joins.bounded_broadcasts(*dfs, max_bytes=0))
        old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_mart_without_broadcast_equals_small_plan(spark, small_dir):
    inp = card_warehouse(spark, small_dir)
    small = mart.build_mart(inp)
    expected = spark.createDataFrame(small.collect(), small.schema)
    with at_scale_plan(spark):
        big = mart.build_mart(inp)
        rows = big.collect()                     # runs on big's own query execution
        plan = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") >= 5
    assert same_rows(spark.createDataFrame(rows, expected.schema), expected)


def test_audit_and_calendar_without_broadcast(spark, small_dir):
    inp = card_warehouse(spark, small_dir)
    with at_scale_plan(spark):
        got = audit.rule_audit_counts(inp.fee_txn, inp.cards).first()
        d = inp.fee_txn.distinct()
        assert got.n_rows == d.count()
        assert got.n_matched == mart.fee_txn_kept(d, inp.cards).count()
        lines = cal.order_line_dates(read_table(spark, small_dir, "orders"),
                                     read_table(spark, small_dir, "lineitem"))
        plan = cal.day_gap_counts(lines)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        for job in (cal.lookback_totals(read_table(spark, small_dir, "orders")), cal.expand_days(lines)):
            hinted = job._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")
            assert hinted <= 1                   # the per-year carry, at most 9999 rows


def test_a_bloom_filter_of_the_known_cards_meets_the_transactions_before_their_shuffle(spark, small_dir):
    """Spark adds it where the scan is large and the cards are few; the sizes are lowered to those of the test."""
    conf = {**NO_BROADCAST, "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    inp = card_warehouse(spark, small_dir)
    expected = sorted(map(str, mart.fee_txn_kept(inp.fee_txn, inp.cards).collect()))
    mid_rows = sorted(map(str, mart.card_tran_mid(inp).collect()))
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        kept = mart.fee_txn_kept(inp.fee_txn, inp.cards)
        mid = mart.card_tran_mid(inp)
        for df, rows in ((kept, expected), (mid, mid_rows)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "might_contain" in plan, plan
            assert sorted(map(str, df.collect())) == rows
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
