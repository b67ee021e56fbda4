"""Cluster entry points.

Run one registered query over a folder of input tables::

    spark-submit --py-files tessera.zip run_query.py query card_pos_tran \\
        --input /data/tables --output /data/out/ldm_card_pos_tran

Run the trigger stream against the warehouse (messages from Kafka, or text
files dropped into a folder; the control table over JDBC, or built in)::

    spark-submit --packages <kafka connector> --py-files tessera.zip run_query.py \\
        dispatch --warehouse edw --checkpoint /shared/ckpt/dispatch \\
        --kafka-bootstrap broker:9092 --topic tasks --jdbc-url jdbc:...

Remove what killed applications left in the shared folder::

    spark-submit --py-files tessera.zip run_query.py sweep --idle-hours 24

The session comes from ``spark-submit``; settings of ``CLUSTER_CONF`` are
applied only where the cluster configuration does not set them.
"""

from __future__ import annotations

import argparse
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from . import catalog
from .plans import mart
from .session import CLUSTER_CONF, shared_dir, sweep
from .sources import catalog_inputs, read_tasks
from .streaming import TriggerDispatcher, message_stream, run_trigger_stream

# Fixed value: the mart's task name in the control table.
MART_TASK = "RUN_LDM_CARD_POS_TRAN"


def session(app_name: str) -> SparkSession:
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    conf, refused = spark.sparkContext.getConf(), []
    for key, value in CLUSTER_CONF.items():
        if not conf.contains(key):
            try:
                spark.conf.set(key, value)
            except AnalysisException:   # a static setting
                refused.append(f"{key}={value}")
    if refused:
        warnings.warn("not applied, give them to spark-submit with --conf: " + ", ".join(refused))
    shared_dir(spark)
    return spark


def run_query(args) -> None:
    spark = session(f"tessera-{args.query}")
    result = catalog.QUERIES[args.query](spark, args.input)
    writer = result.write.mode("overwrite")
    if args.output:
        writer.parquet(args.output)
    else:
        writer.saveAsTable(args.table)


def run_dispatch(args):
    spark = session("tessera-dispatch")
    opts = dict(x.split("=", 1) for x in args.jdbc_option)
    if args.jdbc_table:
        opts["dbtable"] = args.jdbc_table

    def tasks(s):      # read again at every batch, like the reference's lookup
        return read_tasks(s, jdbc_url=args.jdbc_url, jdbc_options=opts)

    kafka = ({"kafka.bootstrap.servers": args.kafka_bootstrap, "subscribe": args.topic}
             if args.kafka_bootstrap else None)
    job = mart.mart_task_job(lambda s: catalog_inputs(s, args.warehouse), args.warehouse,
                             load_date=args.load_date, spread_keys=args.spread_keys)
    dispatcher = TriggerDispatcher(tasks, {MART_TASK: job},
                                   f"{args.checkpoint.rstrip('/')}/audit")
    query = run_trigger_stream(message_stream(spark, path=args.inbox, kafka=kafka), dispatcher,
                               f"{args.checkpoint.rstrip('/')}/offsets",
                               processing_time=args.every, available_now=args.once)
    query.awaitTermination()
    return dispatcher


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="mode", required=True)

    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("query", choices=sorted(catalog.QUERIES))
    q.add_argument("--input", required=True, help="folder holding <table>.parquet inputs")
    out = q.add_mutually_exclusive_group(required=True)
    out.add_argument("--output", help="parquet path to overwrite with the result")
    out.add_argument("--table", help="table (db.name) to overwrite with the result")

    d = sub.add_parser("dispatch", help="run the trigger stream against the warehouse")
    d.add_argument("--warehouse", required=True, help="database holding the five input tables")
    d.add_argument("--checkpoint", required=True, help="shared folder for offsets and audit")
    src = d.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka-bootstrap")
    src.add_argument("--inbox", help="folder of text files, one message per line")
    d.add_argument("--topic")
    control = d.add_mutually_exclusive_group(required=True)
    control.add_argument("--jdbc-url", help="database that holds the control table")
    control.add_argument("--builtin-tasks", action="store_true", help="the built-in control rows")
    d.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE",
                   help="user, password, driver ... of the control table; may be repeated")
    d.add_argument("--jdbc-table")
    d.add_argument("--load-date", default=mart.DEFAULT_LOAD_DATE,
                   help="HIS_DW_DATE written into the mart rows")
    d.add_argument("--spread-keys", action="store_true",
                   help="no (card, trace number, time) holds many rows: the history is shuffled once")
    d.add_argument("--every", default="1 minute", help="micro-batch interval")
    d.add_argument("--once", action="store_true", help="process what is available, then stop")

    s = sub.add_parser("sweep", help="remove scratch folders of applications that were killed")
    s.add_argument("--idle-hours", type=float, default=24, help="hours without a sign of life")

    args = p.parse_args(argv)
    if args.mode == "sweep":
        return sweep(session("tessera-sweep"), args.idle_hours)
    return run_query(args) if args.mode == "query" else run_dispatch(args)


if __name__ == "__main__":
    main()
