"""Mart invariants and plan shape."""

import re

from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import bounded_broadcast, held_bytes, written
from tessera.plans import audit, mart, sinks
from tessera.session import scratch_path
from tessera.sources import TABLE_NAMES, card_inputs, card_warehouse, read_table


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_joins_never_drop_rows(spark, small_dir):
    inp = card_warehouse(spark, small_dir)
    mid = mart.card_tran_mid(inp)
    out = mart.card_pos_tran(mid, inp.online_history)
    assert out.count() >= mid.count() > 0
    assert out.columns == mart.MART_COLS


def test_inner_join_rewrite_equals_semi_then_left(spark, small_dir):
    inp = card_warehouse(spark, small_dir)
    info = mart.card_info(inp.cards)
    kept = mart.fee_txn_kept(inp.fee_txn, inp.cards)
    # The reference's literal form: semi join, then a left join.
    b = info.select(*[F.col(c).alias(f"b_{c}") for c in info.columns])
    literal = kept.join(b, kept["PAN"] == b["b_CRD_NO"], "left")
    assert literal.where(F.col("b_CRD_NO").isNull()).count() == 0
    assert literal.count() == mart.fee_txn_enriched(inp.fee_txn, info).count()


def test_history_distinct_idempotent(spark, small_dir):
    h = mart.history_dim(card_warehouse(spark, small_dir).online_history)
    assert mart.history_dim(h).count() == h.count()


def test_kind_fan_out_kept(spark):
    cards = spark.createDataFrame(
        [("1", "0", "00000058", "AUTO", "1", "a", "c", "b"),
         ("2", "0", "00000058", "CAR", "1", "a", "c", "b")],
        "CRD_NO string, CRD_TYP string, CRD_KND string, CRD_KND_NM string, CRD_STS string, "
        "AC string, CINO string, OPN_BR string")
    assert mart.card_info(cards).count() == 4


def test_rule_audit_counts_match_brute_force(spark, small_dir):
    inp = card_warehouse(spark, small_dir)
    info = mart.card_info(inp.cards)
    got = audit.rule_audit_counts(inp.fee_txn, inp.cards).first()
    d = inp.fee_txn.distinct()
    assert got.n_rows == d.count()
    assert got.n_matched == mart.fee_txn_kept(d, inp.cards).count()
    # the literal membership list (D's card numbers) gives the same count
    d_list = mart.card_numbers(info)
    literal = d.where(mart.rules.passes_rules()).join(
        d_list, d["PAN"] == d_list["CRD_NO"], "left_semi")
    assert got.n_matched == literal.count()


def test_known_cards_equal_card_info_numbers(spark, small_dir):
    cards = card_warehouse(spark, small_dir).cards
    a = mart.known_cards(cards).distinct()
    b = mart.card_numbers(mart.card_info(cards)).distinct()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_warehouse_equals_derivation(spark, small_dir):
    w, d = card_warehouse(spark, small_dir), card_inputs(spark, small_dir)
    assert w.fee_txn.exceptAll(d.fee_txn).count() == 0
    assert d.fee_txn.exceptAll(w.fee_txn).count() == 0


def test_bounded_broadcast(spark):
    small = spark.range(10)
    assert "BroadcastExchange" in plan_text(spark.range(1000).join(bounded_broadcast(small), "id"))
    big = bounded_broadcast(spark.range(100), max_bytes=50)
    plan = plan_text(spark.range(1000).hint("merge").join(big.hint("merge"), "id"))
    assert "SortMergeJoin" in plan


def test_scan_pruned_and_filter_pushed(spark, small_dir):
    inp = card_inputs(spark, small_dir)
    plan = plan_text(mart.fee_txn_kept(inp.fee_txn, inp.cards))
    # lineitem is read with only the columns the rules and mart need
    assert "l_linestatus" not in plan and "l_shipdate" not in plan
    assert "LeftSemi" in plan


def test_upper_org_tags(spark, small_dir):
    tags = audit.upper_org_by_partition(card_warehouse(spark, small_dir).branches)
    rows = tags.collect()
    assert rows and all(r.TAG.split("_", 1)[0].isdigit() for r in rows)
    assert all(r.TAG.split("_", 1)[1].startswith("00000") for r in rows)
    assert sorted(r.TAG for r in tags.collect()) == sorted(r.TAG for r in rows)
    assert tags.storageLevel.useDisk and tags.storageLevel.useMemory
    tags.unpersist()


def test_branch_lookup(spark, small_dir):
    br = card_warehouse(spark, small_dir).branches
    assert audit.branch_lookup(br).count() == 0          # the reference's head office
    got = audit.branch_lookup(br, "00000003").collect()
    assert len(got) == 1 and got[0].org_id == "00000003"


def test_rule_prefilter_reaches_the_scan(spark, small_dir):
    import contextlib
    import io
    inp = card_warehouse(spark, small_dir)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        mart.fee_txn_kept(inp.fee_txn, inp.cards).explain("formatted")
    plan = buf.getvalue()
    assert "In(MSG_TYP" in plan and "In(POS_CD" in plan and "StringStartsWith(PRO_CD" in plan


def test_kept_transactions_have_all_columns_and_the_mart_reads_its_own(spark, small_dir):
    inp = card_warehouse(spark, small_dir)
    extra = [f"EXTRA_{i}" for i in range(26)]
    wide = written(inp.fee_txn.select("*", *[F.lit(c).alias(c) for c in extra]), "test/wide")
    kept = mart.fee_txn_kept(wide, inp.cards)
    assert kept.columns == mart.FEE_TXN_COLS + extra
    assert "EXTRA_3" not in plan_text(mart.fee_txn_enriched(wide, mart.card_info(inp.cards)))


def test_changed_input_gives_new_rows(spark, small_dir):
    base = scratch_path(spark, "test/changed")
    for name in TABLE_NAMES[:7]:
        read_table(spark, small_dir, name).write.parquet(f"{base}/{name}.parquet")
    before = card_warehouse(spark, base).cards.count()
    customer = read_table(spark, small_dir, "customer")
    customer.where("c_custkey < 10").write.mode("overwrite").parquet(f"{base}/customer.parquet")
    assert (before, card_warehouse(spark, base).cards.count()) == (customer.count(), 10)


def test_branch_lookup_reads_only_its_tables(spark, small_dir):
    base = scratch_path(spark, "test/branches")
    for name in ("supplier", "nation", "region"):        # the others are not there at all
        read_table(spark, small_dir, name).write.parquet(f"{base}/{name}.parquet")
    assert catalog.QUERIES["branch_lookup"](spark, base).count() == 1


def test_history_is_derived_without_a_second_fact_join(spark, small_dir):
    plan = plan_text(card_warehouse(spark, small_dir).online_history)
    assert "Join" not in plan


def test_overwritten_tables_of_two_calls_stand_side_by_side(spark, small_dir):
    first = catalog.QUERIES["mart_overwrite_readback"](spark, small_dir)
    second = catalog.QUERIES["mart_overwrite_readback"](spark, small_dir)
    assert first.count() == second.count() > 0


def test_load_time_is_written(spark, small_dir):
    rows = sinks.with_load_time(spark.range(3)).collect()
    assert all(re.fullmatch(r"[0-9 :.\-/]+", str(r.load_ts)) for r in rows)


def test_tag_facts_release_their_cache(spark, small_dir):
    audit.upper_org_tag_facts(card_warehouse(spark, small_dir).branches).collect()
    cached = spark.sparkContext._jsc.getPersistentRDDs()
    assert not [r for r in cached.values() if "TAG" in str(r.toDebugString())]


def test_size_check_counts_bytes_where_the_rows_are(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as string) as text")
    assert held_bytes(df) > 1000 * 32


def jobs_of(spark, build):
    """Spark jobs that ``build()`` runs in this thread."""
    import uuid
    group, sc = uuid.uuid4().hex, spark.sparkContext
    sc.setJobGroup(group, "counted")
    try:
        out = build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_warm_inputs_are_found_without_a_job(spark, small_dir):
    from tessera.sources import WAREHOUSE_TABLES
    for field in WAREHOUSE_TABLES:
        getattr(card_warehouse(spark, small_dir), field)
    warm = card_warehouse(spark, small_dir)
    assert jobs_of(spark, lambda: [getattr(warm, field) for field in WAREHOUSE_TABLES])[1] == 0


def test_manifest_sees_the_files_that_the_scan_reads(spark, small_dir):
    from tessera.sources import InputManifest
    base = scratch_path(spark, "test/manifest")
    supplier = read_table(spark, small_dir, "supplier")
    supplier.withColumn("n", F.col("s_nationkey") % 3).write.partitionBy("n").parquet(f"{base}/supplier.parquet")
    listed = InputManifest(spark, base)
    files = [f for f, _, _ in listed.files("supplier")]
    assert sorted(files) == sorted(x.replace("file:///", "file:/") for x in spark.read.parquet(f"{base}/supplier.parquet").inputFiles())
    same = InputManifest(spark, base).identity(("supplier",))
    assert listed.identity(("supplier",)) == same
    supplier.limit(1).withColumn("n", F.lit(1)).write.mode("append").partitionBy("n").parquet(f"{base}/supplier.parquet")
    assert listed.identity(("supplier",)) == same                # listed once
    assert InputManifest(spark, base).identity(("supplier",)) != same
    assert InputManifest(spark, base).files("nation") == []      # not there


def test_a_table_is_written_once_by_threads_that_ask_at_once(spark, small_dir, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    from tessera.sources import cards
    base = scratch_path(spark, "test/threads")
    read_table(spark, small_dir, "customer").write.parquet(f"{base}/customer.parquet")
    made = []
    monkeypatch.setattr(cards, "_derive", lambda *a, real=cards._derive: made.append(a[2]) or real(*a))
    with ThreadPoolExecutor(4) as pool:
        frames = list(pool.map(lambda _: card_warehouse(spark, base).cards, range(4)))
    assert made == ["cards"] and len({id(f) for f in frames}) == 1


def test_a_failed_write_of_a_table_is_tried_again(spark, small_dir, monkeypatch):
    import pytest

    from tessera.sources import cards
    base = scratch_path(spark, "test/failed")
    read_table(spark, small_dir, "customer").write.parquet(f"{base}/customer.parquet")
    with monkeypatch.context() as m:
        m.setattr(cards, "written", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            card_warehouse(spark, base).cards
    assert card_warehouse(spark, base).cards.count() > 0


def test_size_check_is_the_job_that_writes_the_side(spark, small_dir):
    from tessera.operators.joins import measured
    source = written(spark.range(1000).selectExpr("id", "cast(id as string) as text"), "test/side")
    (fixed, size), jobs = jobs_of(spark, lambda: measured(source))
    assert jobs == 1
    assert size == held_bytes(source) == held_bytes(fixed)
    assert measured(source.where("id < 0"))[1] == 0
