"""Task control table (SRC-3) and the trigger-message feed.

In a deployment the control table is read over JDBC and the messages come
from a Kafka topic; neither driver is on this class path, so offline the
table comes from ``DEFAULT_TASKS`` and the messages are derived from
``events``.  Only these two constructors differ between the two settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TASK_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType(), False),
    T.StructField("task_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("dep_tables", T.StringType(), True),
])

# The mart's task as registered in the control table, plus one
# task whose message never arrives.
DEFAULT_TASKS = (
    (1, "RUN_LDM_CARD_POS_TRAN", "ldm_card_pos_tran", "m_mmp_fee_txn,o_rps_bad_cardinfo_his"),
    (2, "RUN_LDM_CARD_DAILY", "ldm_card_daily", "m_mmp_fee_txn"),
)

# Fixed value: the event type that stands for the mart's trigger message.
MART_TRIGGER = ("purchase", "RUN_LDM_CARD_POS_TRAN")


def read_tasks(spark: SparkSession, jdbc_url: str | None = None,
               jdbc_options: dict | None = None) -> DataFrame:
    """SRC-3: all rows of the control table, four columns."""
    if jdbc_url:
        opts = dict(jdbc_options or {})
        opts.setdefault("dbtable", "task")
        return (spark.read.format("jdbc").option("url", jdbc_url).options(**opts).load()
                .select([F.col(f.name).cast(f.dataType) for f in TASK_SCHEMA.fields]))
    return spark.createDataFrame(list(DEFAULT_TASKS), TASK_SCHEMA)


def trigger_messages(events: DataFrame) -> DataFrame:
    """One message per event: the task name the event stands for, as ``value``."""
    event_type, task_name = MART_TRIGGER
    return events.select(
        F.when(F.col("event_type") == event_type, task_name)
        .otherwise(F.col("event_type")).alias("value"))
