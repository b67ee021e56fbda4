"""Overwriting a table: readers see the old rows or the new ones, a failed write changes nothing."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import sinks

DB = "tessera_test_sinks"


@pytest.fixture
def table(spark, request):
    sinks.ensure_database(spark, DB)
    name = f"{DB}.{request.node.name}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def ids(df):
    return sorted(r.id for r in df.collect())


def versions(spark, table):
    """Data folders of the table."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{spark.catalog.getDatabase(DB).locationUri}/{table.split('.')[1]}__versions")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def test_a_reader_that_planned_before_the_rewrite_sees_the_old_rows(spark, table):
    sinks.overwrite_table(spark.range(3), table)
    reader = spark.table(table)
    other = spark.newSession().table(table)
    sinks.overwrite_table(spark.range(10, 15), table)
    assert ids(reader) == ids(other) == [0, 1, 2]
    assert ids(spark.table(table)) == ids(spark.newSession().table(table)) == [10, 11, 12, 13, 14]
    assert ids(spark.sql(f"select * from {table}")) == [10, 11, 12, 13, 14]


def test_rows_read_from_the_table_may_overwrite_it(spark, table):
    sinks.overwrite_table(spark.range(5), table)
    sinks.overwrite_table(spark.table(table).where("id > 2"), table)
    assert ids(spark.table(table)) == [3, 4]


def test_a_failed_write_leaves_the_old_table(spark, table):
    sinks.overwrite_table(spark.range(3), table)
    before = versions(spark, table)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("bad row")).cast("long"))
                                  .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        sinks.overwrite_table(bad, table)
    assert ids(spark.table(table)) == [0, 1, 2]
    assert versions(spark, table) == before


def test_only_the_current_and_the_previous_rows_are_kept(spark, table):
    for n in range(1, 6):
        sinks.overwrite_table(spark.range(n), table)
        assert len(versions(spark, table)) == min(n, 2)
    assert ids(spark.table(table)) == [0, 1, 2, 3, 4]


def test_a_table_saved_in_its_own_place_is_taken_over(spark, table):
    spark.range(3).write.saveAsTable(table)
    for n in (4, 5):
        sinks.overwrite_table(spark.range(n), table)
        assert spark.table(table).count() == n


def test_other_columns_and_partitions(spark, table):
    sinks.overwrite_table(spark.range(3), table)
    sinks.overwrite_table(spark.range(4).withColumn("name", F.lit("x")), table)
    assert spark.table(table).columns == ["id", "name"] and spark.table(table).count() == 4
    by = spark.range(6).withColumn("part", F.col("id") % 2)
    sinks.overwrite_table(by, table, partition_by=["part"])
    assert ids(spark.table(table).where("part = 1")) == [1, 3, 5]
    sinks.overwrite_table(by.where("id > 3"), table, partition_by=["part"])
    assert ids(spark.table(table)) == [4, 5]
    sinks.overwrite_table(spark.range(2), table, checkpoint=True)
    assert ids(spark.table(table)) == [0, 1]


def test_dropping_the_table_drops_its_rows(spark, table):
    sinks.overwrite_table(spark.range(3), table)
    spark.sql(f"DROP TABLE {table}")
    assert versions(spark, table) == []
    sinks.overwrite_table(spark.range(2), table)
    assert ids(spark.table(table)) == [0, 1]


def test_name_without_a_database_is_one_of_the_current(spark, table):
    with sinks.current_database(spark, DB):
        sinks.overwrite_table(spark.range(3), table.split(".")[1])
    assert spark.table(table).count() == 3
