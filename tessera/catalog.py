"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables (or data Spark derives from them) whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import audit, calendar_jobs as cal, mart, sinks
from .session import scratch_path
from .sources import card_warehouse, read_table, read_tasks, trigger_messages
from .streaming import (TriggerDispatcher, message_stream, read_audit, run_trigger_stream,
                        task_message_counts)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: branch key for the point lookup that exists in the fixture
# (the reference looks up its own head-office code).
LOOKUP_BRANCH = "00000003"

# Database of the registered queries' own tables; each call writes tables of
# its own name there, never a production name.
QUERY_DATABASE = "tessera_queries"


def _inputs(spark, sf_dir):
    return card_warehouse(spark, sf_dir)


def q_card_pos_tran(spark, sf_dir):
    return mart.build_mart(_inputs(spark, sf_dir))


def q_branch_distinct(spark, sf_dir):
    return mart.branch_dim(_inputs(spark, sf_dir).branches)


def q_card_info_filtered(spark, sf_dir):
    return mart.live_cards(_inputs(spark, sf_dir).cards)


def q_card_kind_dim(spark, sf_dir):
    return mart.kind_dim(_inputs(spark, sf_dir).cards)


def q_card_info_with_kind(spark, sf_dir):
    return mart.card_info(_inputs(spark, sf_dir).cards)


def q_fee_txn_rules(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return mart.fee_txn_kept(inp.fee_txn, inp.cards)


def q_fee_sign_digits(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return mart.fee_sign_digits(mart.fee_txn_kept(inp.fee_txn, inp.cards))


def q_fee_txn_enriched(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return mart.fee_txn_enriched(inp.fee_txn, mart.card_info(inp.cards))


def q_card_tran_mid(spark, sf_dir):
    return mart.card_tran_mid(_inputs(spark, sf_dir))


def q_online_history_distinct(spark, sf_dir):
    return mart.history_dim(_inputs(spark, sf_dir).online_history)


def q_rule_audit_counts(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return audit.rule_audit_counts(inp.fee_txn, inp.cards)


def q_branch_lookup(spark, sf_dir):
    return audit.branch_lookup(_inputs(spark, sf_dir).branches, LOOKUP_BRANCH)


def q_upper_org_by_partition(spark, sf_dir):
    return audit.upper_org_tag_facts(_inputs(spark, sf_dir).branches)


def q_stage_views_sql(spark, sf_dir):
    mart.register_stages(mart.mart_stages(_inputs(spark, sf_dir)))
    return spark.sql("SELECT * FROM ldm_card_pos_tran_stage WHERE MSG_TYP = '1'")


def q_mart_overwrite_readback(spark, sf_dir):
    inputs, call = _inputs(spark, sf_dir), uuid.uuid4().hex
    sinks.ensure_database(spark, QUERY_DATABASE)
    # the lineage cut is shown on a small table; the mart is written once
    sinks.overwrite_table(mart.branch_dim(inputs.branches), f"{QUERY_DATABASE}.branches_{call}", checkpoint=True)
    rows = sinks.with_load_time(mart.build_mart(inputs))
    sinks.overwrite_table(rows, f"{QUERY_DATABASE}.mart_{call}")
    with sinks.current_database(spark, QUERY_DATABASE):
        written = spark.table(f"mart_{call}")       # resolved in the current database
    return written.drop("load_ts")


def q_control_tasks(spark, sf_dir):
    messages = trigger_messages(read_table(spark, sf_dir, "events"))
    return task_message_counts(read_tasks(spark), messages)


def q_trigger_dispatch(spark, sf_dir, database: str | None = None):
    """Messages derived from ``events`` are dropped as text files, one
    available-now run of the dispatch stream consumes them (running the mart
    job for its task), and the audit table is summed per matched task.  The task's table is written to
    ``database``, or to one of this call's own."""
    database = database or f"{QUERY_DATABASE}_{uuid.uuid4().hex}"
    base = scratch_path(spark, "trigger")
    trigger_messages(read_table(spark, sf_dir, "events")).write.text(f"{base}/inbox")
    job = mart.mart_task_job(lambda s: _inputs(s, sf_dir), database)
    registry = {"RUN_LDM_CARD_POS_TRAN": job}
    dispatcher = TriggerDispatcher(read_tasks, registry, f"{base}/audit")   # re-read per batch
    stream = message_stream(spark, path=f"{base}/inbox")
    query = run_trigger_stream(stream, dispatcher, f"{base}/checkpoint", available_now=True)
    query.awaitTermination()            # ends with the available messages, or raises
    audit = read_audit(spark, f"{base}/audit")
    return (audit.where("matched").groupBy("task_name", "table_name")
            .agg(F.sum("n_messages").alias("n_messages")))


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders")


def _lines(spark, sf_dir):
    return cal.order_line_dates(_orders(spark, sf_dir), read_table(spark, sf_dir, "lineitem"))


CALENDAR_QUERIES: dict[str, Query] = {
    "cal_shift_days": lambda spark, d: cal.shift_days(_orders(spark, d)),
    "cal_shift_months": lambda spark, d: cal.shift_months(_orders(spark, d)),
    "cal_shift_instants": lambda spark, d: cal.shift_instants(read_table(spark, d, "events")),
    "cal_shift_units": lambda spark, d: cal.shift_units(read_table(spark, d, "events")),
    "cal_lookback_totals": lambda spark, d: cal.lookback_totals(_orders(spark, d)),
    "cal_day_gap": lambda spark, d: cal.day_gap_counts(_lines(spark, d)),
    "cal_expand_days": lambda spark, d: cal.expand_days(_lines(spark, d)),
    "cal_age_months": lambda spark, d: cal.age_month_counts(_lines(spark, d)),
    "cal_bounds": lambda spark, d: cal.bounds(_orders(spark, d)),
    "cal_period_flags": lambda spark, d: cal.period_flags(_orders(spark, d)),
    "cal_text_month_end": lambda spark, d: cal.text_month_end(_orders(spark, d)),
    "cal_labels": lambda spark, d: cal.labels(_orders(spark, d)),
    "cal_parse_labels": lambda spark, d: cal.parse_labels(_orders(spark, d)),
}


QUERIES: dict[str, Query] = {
    "card_pos_tran": q_card_pos_tran,
    "branch_distinct": q_branch_distinct,
    "card_info_filtered": q_card_info_filtered,
    "card_kind_dim": q_card_kind_dim,
    "card_info_with_kind": q_card_info_with_kind,
    "fee_txn_rules": q_fee_txn_rules,
    "fee_sign_digits": q_fee_sign_digits,
    "fee_txn_enriched": q_fee_txn_enriched,
    "card_tran_mid": q_card_tran_mid,
    "online_history_distinct": q_online_history_distinct,
    "rule_audit_counts": q_rule_audit_counts,
    "branch_lookup": q_branch_lookup,
    "upper_org_by_partition": q_upper_org_by_partition,
    "stage_views_sql": q_stage_views_sql,
    "mart_overwrite_readback": q_mart_overwrite_readback,
    "control_tasks": q_control_tasks,
    "trigger_dispatch": q_trigger_dispatch,
    **CALENDAR_QUERIES,
}
