"""Cluster entry points: the mart over catalog tables, the dispatch command."""

import pytest

from tessera import run
from tessera.plans import mart, sinks
from tessera.session import scratch_path
from tessera.sources import (WAREHOUSE_TABLES, card_warehouse, catalog_inputs, read_table,
                             trigger_messages)

DB = "tessera_test_wh"


def _warehouse_db(spark, small_dir):
    sinks.ensure_database(spark, DB)
    wh = card_warehouse(spark, small_dir)
    for field, table in WAREHOUSE_TABLES.items():
        getattr(wh, field).write.mode("overwrite").saveAsTable(f"{DB}.{table}")


def test_mart_over_catalog_tables(spark, small_dir):
    _warehouse_db(spark, small_dir)
    a = mart.build_mart(catalog_inputs(spark, DB))
    b = mart.build_mart(card_warehouse(spark, small_dir))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dispatch_command_once(spark, small_dir):
    _warehouse_db(spark, small_dir)
    base = scratch_path(spark, "test-run-dispatch")
    trigger_messages(read_table(spark, small_dir, "events")).write.text(f"{base}/inbox")
    before = dict(spark.conf.getAll)
    try:
        dispatcher = run.main(["dispatch", "--warehouse", DB, "--checkpoint", f"{base}/ckpt",
                               "--inbox", f"{base}/inbox", "--once", "--builtin-tasks", "--load-date", "2024-01-31"])
    finally:
        for k, v in dict(spark.conf.getAll).items():
            if k not in before:
                spark.conf.unset(k)
            elif before[k] != v:
                spark.conf.set(k, before[k])
    assert [r[1:] for r in dispatcher.runs] == [("RUN_LDM_CARD_POS_TRAN", "ldm_card_pos_tran")]
    table = spark.table(f"{DB}.ldm_card_pos_tran").drop("load_ts")
    assert table.columns == mart.MART_COLS
    assert table.count() == mart.build_mart(catalog_inputs(spark, DB)).count()
    assert {r.HIS_DW_DATE for r in table.select("HIS_DW_DATE").distinct().collect()} == {"2024-01-31"}


def test_query_command_writes_parquet(spark, small_dir):
    out = scratch_path(spark, "test-run-query") + "/out"
    before = dict(spark.conf.getAll)
    try:
        run.main(["query", "cal_period_flags", "--input", small_dir, "--output", out])
    finally:
        for k, v in dict(spark.conf.getAll).items():
            if k not in before:
                spark.conf.unset(k)
            elif before[k] != v:
                spark.conf.set(k, before[k])
    written = spark.read.parquet(out)
    orders = read_table(spark, small_dir, "orders").count()
    assert written.agg({"n_orders": "sum"}).first()[0] == orders


def test_dispatch_needs_a_control_source():
    with pytest.raises(SystemExit):
        run.main(["dispatch", "--warehouse", DB, "--checkpoint", "x", "--inbox", "y", "--once"])


def test_refused_settings_are_named(spark):
    before = dict(spark.conf.getAll)
    try:
        with pytest.warns(UserWarning, match="spark.shuffle.push.enabled"):
            run.session("tessera-tests")
    finally:
        for k, v in dict(spark.conf.getAll).items():
            if k not in before:
                spark.conf.unset(k)
            elif before[k] != v:
                spark.conf.set(k, before[k])
