"""Sinks: overwrite a managed table and read it back (SRC-2, SNK-1, SNK-2, DT-30)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..functions import dates
from ..operators import checkpointed

#: Table property: the folder that held the table's rows before the last overwrite.
PREVIOUS = "tessera.previous_folder"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database when missing, in the warehouse's own place unless ``location`` says
    otherwise."""
    if not spark.catalog.databaseExists(name):
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


@contextmanager
def current_database(spark: SparkSession, name: str, location: str | None = None):
    """SRC-2: ``use <name>`` for the block (the database is created when missing),
    then back to the previous one.  Writes should still name their table
    fully: a frame built on another session (e.g. a stream's batch session)
    does not see this session's current database."""
    previous = spark.catalog.currentDatabase()
    ensure_database(spark, name, location)
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(previous)


def overwrite_table(df: DataFrame, table: str, checkpoint: bool = False,
                    partition_by: list[str] | None = None) -> None:
    """SNK-1 (SNK-2 with ``checkpoint``): replace ``table`` (``db.name``) with ``df``.  With ``checkpoint`` the rows are first cut
    from their lineage on the shared checkpoint folder and that copy is written
    (the checkpointed frame is the one used, so the plan runs once).

    The rows are written to a fresh folder beside the table, then the table is pointed to it, so readers see
    the old rows or the new ones, and a failed write leaves the table as it was.  The folder that was current
    before stays for the readers that have planned over it, until the next overwrite.  A table of other
    columns, or one with partitions, is dropped and made anew over the written folder: its name is
    missing for the two statements in between, its rows are not."""
    if checkpoint:
        df = checkpointed(df)
    spark = df.sparkSession
    database, _, name = table.replace("`", "").rpartition(".")
    database = database.rpartition(".")[2] or spark.catalog.currentDatabase()
    table = f"`{database}`.`{name}`"
    folder = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__versions/{uuid.uuid4().hex}"
    writer = df.write.mode("error").partitionBy(*partition_by or ())
    try:
        writer.parquet(folder)
        written = spark.read.parquet(folder)
        _point(spark, table, folder, written, partition_by or [])
    except BaseException:
        _remove(spark, folder)
        raise


def _point(spark: SparkSession, table: str, folder: str, written: DataFrame, partition_by: list[str]) -> None:
    exists = spark.catalog.tableExists(table)
    before, dropped = _place(spark, table) if exists else (None, None)
    plain = exists and not partition_by and not any(c.isPartition for c in spark.catalog.listColumns(table))
    if not (plain and _columns(spark.table(table)) == _columns(written)):
        if exists:
            spark.sql(f"DROP TABLE {table}")               # a managed table's current folder goes with it
        partitions = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({written._jdf.schema().toDDL()}) USING parquet{partitions}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    if before:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{before}')")
    spark.catalog.refreshTable(table)
    if dropped and dropped not in (before, folder):
        _remove(spark, dropped)


def _columns(df: DataFrame) -> list[tuple]:
    return [(f.name, f.dataType) for f in df.schema.fields]


def _place(spark: SparkSession, table: str) -> tuple[str, str | None]:
    """The table's current folder, and the one it had before."""
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first().data_type
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return location, properties.get(PREVIOUS)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def with_load_time(df: DataFrame, column: str = "load_ts") -> DataFrame:   # DT-30
    return df.withColumn(column, dates.now_label())
