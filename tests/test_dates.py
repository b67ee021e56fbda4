"""Edge rows for the date builders, and the day-expansion sweep against a
brute-force explode."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import dates
from tessera.plans import calendar_jobs as cal

D = dt.date
TS = dt.datetime


def one(spark, col, value, schema):
    return spark.createDataFrame([(value,)], f"x {schema}").select(col).first()[0]


def test_month_shift_clamps(spark):
    df = spark.createDataFrame([(D(2017, 3, 30), -1), (D(2019, 2, 28), 1), (D(2020, 2, 29), 12)],
                               "d date, n int")
    got = [r[0] for r in df.select(dates.add_months("d", F.col("n"))).collect()]
    assert got == [D(2017, 2, 28), D(2019, 3, 28), D(2021, 2, 28)]


def test_month_shift_keeps_time(spark):
    got = one(spark, dates.add_months_ts("x", -1), TS(2017, 3, 30, 10, 5), "timestamp_ntz")
    assert got == TS(2017, 2, 28, 10, 5)


def test_date_and_timestamp_shift_agree_at_midnight(spark):
    df = spark.createDataFrame([(TS(2019, 1, 31),), (TS(2020, 2, 29),), (TS(2017, 12, 31),)],
                               "x timestamp_ntz")
    for n in (-13, -1, 1, 12):
        for r in df.select(dates.add_months("x", n).alias("a"),
                           dates.add_months_ts("x", n).alias("b")).collect():
            assert r.b == TS(r.a.year, r.a.month, r.a.day)


def test_text_month_end(spark):
    cases = {"20000228": False, "19000228": True, "20190229": True, "20201231": True,
             "20200430": True, "20200431": False}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.e for r in df.select("s", dates.text_is_month_end("s").alias("e")).collect()}
    assert got == cases


def test_months_over(spark):
    df = spark.createDataFrame([(D(2020, 1, 15), D(2020, 2, 10)), (D(2020, 3, 10), D(2020, 1, 10)),
                                (D(2020, 3, 11), D(2020, 1, 10))], "a date, b date")
    assert [r[0] for r in df.select(dates.months_over("a", "b")).collect()] == ["0", "2", "3"]


def test_day_gap_truncates_toward_zero(spark):
    base = TS(2024, 1, 15, 12)
    df = spark.createDataFrame([(base, base - dt.timedelta(hours=36)),
                                (base, base + dt.timedelta(hours=23)),
                                (base, base + dt.timedelta(hours=25))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(dates.whole_days_between("a", "b")).collect()] == [-1, 0, 1]


def test_every_day_length(spark):
    df = spark.createDataFrame([(D(2017, 11, 20), D(2017, 11, 23)), (D(2017, 11, 23), D(2017, 11, 20))],
                               "a date, b date")
    got = df.select(F.size(dates.every_day("a", "b")).alias("n"),
                    dates.whole_days_between(F.col("a").cast("timestamp_ntz"),
                                             F.col("b").cast("timestamp_ntz")).alias("g")).collect()
    assert got[0].n == 4 and got[0].n == got[0].g + 1
    assert got[1].n == 0


def test_flags_on_year_end(spark):
    r = spark.createDataFrame([(D(2019, 12, 31),)], "d date").select(
        dates.is_month_end("d").alias("me"), dates.is_year_end("d").alias("ye"),
        dates.is_quarter_end("d").alias("qe"), dates.weekday0("d").alias("w"),
        dates.is_month_start("d").alias("ms"), dates.year_end("d").alias("yend"),
        dates.days_in_month("d").alias("dim")).first()
    assert (r.me, r.ye, r.qe, r.w, r.ms) == (True, True, True, 2, False)
    assert r.yend == D(2019, 12, 31) and r.dim == 31


def test_calendar_field_units(spark):
    t = TS(2020, 1, 31, 10, 0, 0)
    got = spark.createDataFrame([(t,)], "x timestamp_ntz").select(
        dates.add_field("x", 1, 9), dates.add_field("x", 1, 2), dates.add_field("x", -2, 3),
        dates.add_field("x", 250, 14)).first()
    assert got[0] == TS(2020, 1, 31, 22) and got[1] == TS(2020, 2, 29, 10)
    assert got[2] == TS(2020, 1, 17, 10) and got[3] == TS(2020, 1, 31, 10, 0, 0, 250000)


def test_parse_quarantine(spark):
    df = spark.createDataFrame([("20190231",), ("20190228",), (None,)], "s string")
    got = df.select(dates.parse_day("s").alias("d"),
                    dates.parse_failed("s", dates.parse_day("s")).alias("bad")).collect()
    assert [(r.d, r.bad) for r in got] == [(None, True), (D(2019, 2, 28), False), (None, False)]


def test_open_days_equals_explode(spark):
    rows = [(D(2017, 11, 20), D(2017, 11, 23)), (D(2017, 11, 22), D(2018, 1, 2)),
            (D(2017, 12, 31), D(2017, 12, 31)), (D(2018, 3, 1), D(2018, 2, 1)),
            (D(2016, 2, 27), D(2016, 3, 2)), (D(2018, 5, 5), D(2018, 5, 6)),
            (D(2012, 6, 1), D(2014, 2, 1))]      # 2013: no start or end inside
    df = spark.createDataFrame(rows, "a date, b date")
    sweep = {r.day: r.n_open for r in cal.open_days(df, "a", "b").collect()}
    brute = {r.day: r.n for r in df.select(F.explode(dates.every_day("a", "b")).alias("day"))
             .groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sweep == brute


def test_parse_ts_keeps_wall_clock_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2019-03-10 02:30:00",), ("2019-13-01 00:00:00",)], "s string")
        got = [r[0] for r in df.select(dates.parse_ts("s", "yyyy-MM-dd HH:mm:ss")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [TS(2019, 3, 10, 2, 30), None]      # 02:30 does not exist in LA that day


def test_day_gap_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")   # DST began at midnight
    try:
        df = spark.createDataFrame([(TS(2018, 11, 4), TS(2018, 11, 5)), (TS(2018, 11, 3), TS(2018, 11, 5))],
                                   "a timestamp_ntz, b timestamp_ntz")
        got = [r[0] for r in df.select(dates.whole_days_between("a", "b")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1, 2]


def test_instants_keep_their_time(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 23:15:30.25' AS t, TIMESTAMP_NTZ'2024-04-01 01:00:00' AS u")
    day = lambda c: str(df.select(c).first()[0])
    assert day(dates.instant("t")) == "2024-03-31 23:15:30.250000"
    assert day(dates.day_before_ts("t")) == "2024-03-30 23:15:30.250000"
    assert day(dates.day_after_ts("t")) == "2024-04-01 23:15:30.250000"
    assert day(dates.same_day_last_month_ts("t")) == "2024-02-29 23:15:30.250000"
    assert day(dates.month_start_ts("t")) == "2024-03-01 23:15:30.250000"
    assert day(dates.month_end_ts("u")) == "2024-04-30 01:00:00"
    assert day(dates.year_start_ts("t")) == "2024-01-01 23:15:30.250000"
    assert day(dates.year_end_ts("t")) == "2024-12-31 23:15:30.250000"
    # whole days, not midnights: 23:15 to 01:00 is one day
    assert df.select(F.size(dates.every_day("t", "u"))).first()[0] == 1
    assert df.select(F.size(dates.every_day("u", "t"))).first()[0] == 1


def test_load_label_of_a_fixed_clock(spark):
    """DT-30: the instant in the session's zone, to the second; without a clock, now."""
    instant = F.expr("timestamp_micros(1582934399987654)")           # 2020-02-28 23:59:59.987654 UTC
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone, text in (("UTC", "2020-02-28 23:59:59"), ("Asia/Shanghai", "2020-02-29 07:59:59"),
                           ("America/Sao_Paulo", "2020-02-28 20:59:59")):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert spark.range(1).select(dates.now_label(instant)).first()[0] == text
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        labels = {r[0] for r in spark.range(3).select(dates.now_label()).collect()}
        after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        assert len(labels) == 1                                      # one instant a query
        assert before <= dt.datetime.strptime(labels.pop(), "%Y-%m-%d %H:%M:%S") <= after
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
