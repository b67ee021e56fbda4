"""Trigger stream (SRC-4, FLT-5, JOIN-8, AGG-4, STM-1..6).

Messages carry a task name.  Every micro-batch is counted per message value,
matched against the control table (a broadcast join behind a size check),
written to an audit table, and each *distinct* matched task's job runs once
for the batch, writing into the task's ``table_name``.  Unmatched messages
only appear in the audit table.

``foreachBatch`` may replay a batch after a failure.  The audit rows of a batch
are written under its batch id with overwrite.  Each job's run stands in a
ledger of the batch: a row when it starts and one when it is done or has
failed.  A replay runs the tasks that are not done, and those alone; a failed
task does not keep the batch's other tasks from running.  The stream's offsets
live in its ``checkpointLocation`` on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bounded_broadcast

Job = Callable[[SparkSession, str], None]

# Audit rows, one folder per batch (``batch_id=<n>``).
AUDIT_SCHEMA = ("message STRING, task_name STRING, table_name STRING, "
                "n_messages BIGINT, matched BOOLEAN")
# The ledger of job runs, one folder per batch; status: started, then done or failed; job_missing for a matched
# task without a job.  ``stream`` is the id that a stream keeps over restarts from its checkpoint.
LEDGER_SCHEMA = ("task_name STRING, table_name STRING, attempt INT, status STRING, error STRING, stream STRING, "
                 "at TIMESTAMP")
# Spark's local property with the running stream's id.
STREAM_ID = "sql.streaming.queryId"


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit table under ``path`` (empty when no batch has run yet)."""
    schema = AUDIT_SCHEMA + ", batch_id BIGINT"
    return _read_batches(spark, path, schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the run ledger beside the audit table ``path`` (empty when no batch has run)."""
    return _read_batches(spark, f"{path}_runs", LEDGER_SCHEMA + ", batch_id BIGINT")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each stream's task in each batch; ``started`` alone means that its run was cut off."""
    later = F.struct("attempt", F.col("status") != "started", "at")
    return (read_ledger(spark, path).groupBy("batch_id", "stream", "task_name", "table_name")
            .agg(F.max("attempt").alias("attempt"), F.max_by("status", later).alias("status"),
                 F.max_by("error", later).alias("error"), F.max("at").alias("at")))


def _read_batches(spark, path, schema):
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":     # only a folder that isn't there yet is empty
            raise
        return spark.createDataFrame([], schema)


def message_stream(spark: SparkSession, path: str | None = None,
                   kafka: Mapping[str, str] | None = None) -> DataFrame:
    """Streaming frame with one STRING column ``value`` (SRC-4, STM-3).

    ``kafka`` holds the source options (``kafka.bootstrap.servers``,
    ``subscribe``...; offsets start at ``latest`` unless given); otherwise
    text files dropped into ``path`` are read, one message per line.
    """
    if kafka:
        opts = {"startingOffsets": "latest", **kafka}
        return (spark.readStream.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value")))
    return spark.readStream.format("text").load(path)


def message_counts(messages: DataFrame) -> DataFrame:
    """AGG-4: messages per value (map-side pre-aggregated)."""
    return messages.groupBy("value").agg(F.count(F.lit(1)).alias("n_messages"))


def task_message_counts(tasks: DataFrame, messages: DataFrame) -> DataFrame:
    """Every task of the control table with the number of messages naming it
    (0 when none arrived).  Counts are cut to task names by a semi join with
    the (small, checked) control table before the outer join."""
    small = bounded_broadcast(tasks)
    counts = message_counts(messages)
    named = counts.join(small, counts["value"] == small["task_name"], "left_semi")
    return (small.join(named, small["task_name"] == named["value"], "left")
            .select("task_id", "task_name", "table_name", "dep_tables",
                    F.coalesce("n_messages", F.lit(0)).alias("n_messages")))


class TriggerDispatcher:
    """``foreachBatch`` function (STM-4): match against the control table
    (FLT-5, JOIN-8), count (AGG-4), audit, and run matched jobs (STM-5).

    ``tasks`` is the control table, or a function ``spark -> control table``
    that is read again at every batch, so edits to the table reach a running
    stream (the table is small; it is size-checked before each broadcast).
    """

    def __init__(self, tasks, registry: Mapping[str, Job], audit_path: str):
        self._load = tasks if callable(tasks) else None
        self._fixed = None if callable(tasks) else self._checked(tasks)
        self.registry = dict(registry)
        self.audit_path = audit_path.rstrip("/")
        # (batch id, task, table) of the last batch's job runs; ``read_runs`` has them all.
        self.runs: list[tuple[int, str, str]] = []

    @staticmethod
    def _checked(tasks: DataFrame) -> DataFrame:
        return bounded_broadcast(tasks.select("task_name", "table_name"))

    def tasks(self, spark: SparkSession) -> DataFrame:
        return self._fixed if self._load is None else self._checked(self._load(spark))

    def audit_rows(self, batch: DataFrame, batch_id: int) -> DataFrame:
        tasks = self.tasks(batch.sparkSession)
        counts = message_counts(batch)
        return (counts.join(tasks, counts["value"] == tasks["task_name"], "left")
                .select(F.lit(batch_id).cast("bigint").alias("batch_id"),
                        F.col("value").alias("message"), "task_name", "table_name",
                        "n_messages", F.col("task_name").isNotNull().alias("matched")))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{self.audit_path}/batch_id={batch_id}"
        self.audit_rows(batch, batch_id).drop("batch_id").write.mode("overwrite").parquet(path)
        # Distinct matched tasks: bounded by the control table, not the stream.
        matched = (spark.read.schema(AUDIT_SCHEMA).parquet(path).where("matched")
                   .select("task_name", "table_name").distinct().collect())
        self.runs = []
        if matched:
            self._run(spark, batch_id, sorted((r.task_name, r.table_name) for r in matched))

    def _run(self, spark: SparkSession, batch_id: int, tasks: list[tuple[str, str]]) -> None:
        """Run the jobs of the batch's tasks that the ledger does not know as done; raise the first failure at the end."""
        path = f"{self.audit_path}_runs/batch_id={batch_id}"
        stream = spark.sparkContext.getLocalProperty(STREAM_ID)
        earlier = [r for r in _read_batches(spark, path, LEDGER_SCHEMA).collect() if r.stream == stream]
        done = {(r.task_name, r.table_name) for r in earlier if r.status == "done"}
        failure = None
        for task, table in tasks:
            if (task, table) in done:
                continue
            attempt = 1 + max((r.attempt for r in earlier if (r.task_name, r.table_name) == (task, table)), default=0)

            def note(status, error=None):
                values = {"task_name": task, "table_name": table, "attempt": attempt, "status": status,  # noqa: B023
                          "error": error, "stream": stream}
                (spark.range(1, numPartitions=1)
                 .select(*[F.lit(v).cast("int" if c == "attempt" else "string").alias(c) for c, v in values.items()],
                         F.current_timestamp().alias("at"))
                 .write.mode("append").parquet(path))

            job = self.registry.get(task)
            if job is None:
                note("job_missing")
                continue
            note("started")
            try:
                job(spark, table)
            except Exception as error:
                note("failed", str(error)[:1000])
                failure = failure or error
            else:
                note("done")
                self.runs.append((batch_id, task, table))
        if failure is not None:
            raise failure


def run_trigger_stream(messages: DataFrame, dispatcher: TriggerDispatcher,
                       checkpoint_location: str, processing_time: str | None = "1 minute",
                       available_now: bool = False) -> StreamingQuery:
    """Start the dispatch stream: every ``processing_time`` (the reference's
    one-minute batches, STM-1), or once over what is available
    (``available_now``); offsets in ``checkpoint_location`` (STM-2).  The
    caller waits with ``awaitTermination`` (STM-6)."""
    writer = (messages.writeStream.foreachBatch(dispatcher)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
