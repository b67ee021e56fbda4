"""Calendar jobs over whole tables, built from the date column builders.

Each job reads ``orders``, ``lineitem`` or ``events`` whole.  Row-level jobs
are single narrow stages (scan -> project, all in whole-stage codegen);
roll-ups aggregate map-side before their one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import checkpointed

# Fixed values of the jobs: shift sizes and the malformed label used to
# exercise parse quarantine.
SHIFT_DAYS = -90
SHIFT_TS_DAYS = 45
BAD_DAY_TEXT = "20190231"


def order_line_dates(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(order date, ship date) per line item."""
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lineitem.select("l_orderkey", "l_shipdate").join(o, "l_orderkey")


# -- row-level shifts ------------------------------------------------------

def shift_days(orders: DataFrame) -> DataFrame:                      # DT-1..3
    d = dates.as_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        d.alias("order_day"),
        dates.day_before(d).alias("day_before"),
        dates.day_after(d).alias("day_after"),
        dates.add_days(d, SHIFT_DAYS).alias("day_shifted"),
        dates.add_days_ts("o_orderdate", SHIFT_TS_DAYS).alias("ts_shifted"),
    )


def shift_months(orders: DataFrame) -> DataFrame:                    # DT-5..7, 9
    d = dates.as_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        dates.previous_month(d).alias("prev_month"),
        dates.label(dates.previous_month(d), dates.MONTH).alias("prev_month_label"),
        dates.add_months(d, -3).alias("minus_3_months"),
        dates.add_years(d, 1).alias("plus_1_year"),
        dates.add_months_ts("o_orderdate", -1).alias("ts_prev_month"),
        dates.add_years_ts("o_orderdate", 1).alias("ts_plus_1_year"),
    )


def shift_instants(events: DataFrame) -> DataFrame:       # DT-1, 2, 4, 5, 14..17, 19, time kept
    return events.select(
        "event_id",
        dates.day_before_ts("ts").alias("day_before"),
        dates.day_after_ts("ts").alias("day_after"),
        dates.same_day_last_month_ts("ts").alias("last_month"),
        dates.month_start_ts("ts").alias("month_start"),
        dates.month_end_ts("ts").alias("month_end"),
        dates.year_start_ts("ts").alias("year_start"),
        dates.year_end_ts("ts").alias("year_end"),
    )


def shift_units(events: DataFrame) -> DataFrame:                     # DT-10, DT-29
    return events.select(
        "event_id",
        dates.instant("ts").alias("same_instant"),
        dates.add_field("ts", 1, 9).alias("plus_half_day"),
        dates.add_field("ts", -2, 3).alias("minus_2_weeks"),
        dates.add_field("ts", -5, 12).alias("minus_5_minutes"),
        dates.add_field("ts", 1, 1).alias("plus_1_year"),
        dates.add_field("ts", 1, 2).alias("plus_1_month"),
        dates.add_field("ts", 3, 5).alias("plus_3_days"),
        dates.add_field("ts", 5, 11).alias("plus_5_hours"),
        dates.add_field("ts", 30, 13).alias("plus_30_seconds"),
        dates.add_field("ts", 250, 14).alias("plus_250_ms"),
    )


# -- look-back -------------------------------------------------------------

def lookback_totals(orders: DataFrame) -> DataFrame:                 # DT-1, 4, 9
    """Daily order totals next to the totals one day, one month and one year
    earlier.  The daily table (one aggregation, map-side combined, so a hot
    day is no hot task) is computed once into the shared checkpoint folder;
    it has one row per date; whether the three look-up joins broadcast it is
    left to Spark, which knows the written table's size."""
    daily = checkpointed(
        orders.groupBy(dates.as_date("o_orderdate").alias("order_day"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total")))

    def back(name):
        return daily.select(F.col("order_day").alias(f"{name}_day"), F.col("total").alias(name))

    out = (daily
           .withColumn("prev_day_day", dates.day_before("order_day"))
           .withColumn("prev_month_day", dates.same_day_last_month("order_day"))
           .withColumn("prev_year_day", dates.add_years("order_day", -1)))
    for name in ("prev_day", "prev_month", "prev_year"):
        out = out.join(back(name), f"{name}_day", "left")
    return out.select(
        "order_day", "n_orders",
        F.round("total", 2).alias("total_price"),
        F.round("prev_day", 2).alias("prev_day_total"),
        F.round("prev_month", 2).alias("prev_month_total"),
        F.round("prev_year", 2).alias("prev_year_total"),
    )


# -- differences and ranges --------------------------------------------------

def day_gap_counts(lines: DataFrame) -> DataFrame:                   # DT-11
    gap = dates.whole_days_between("o_orderdate", "l_shipdate")
    return lines.groupBy(gap.alias("gap_days")).agg(F.count(F.lit(1)).alias("n_lines"))


def age_month_counts(lines: DataFrame) -> DataFrame:                 # DT-13
    age = dates.months_over("l_shipdate", "o_orderdate")
    return lines.groupBy(age.alias("age_months")).agg(F.count(F.lit(1)).alias("n_lines"))


def open_days(intervals: DataFrame, start: str, end: str) -> DataFrame:   # DT-12
    """For every day, how many [start, end] intervals (both ends included,
    start <= end) contain it; days no interval covers are left out.

    Same result as exploding ``every_day(start, end)`` and counting per day,
    without materialising one row per covered day: each interval becomes a
    +1 on its first day and a -1 on the day after its last, pre-aggregated
    map-side per day; a running sum over the calendar then gives the count.
    The day tables hold one row per date, so they are bounded by the DATE
    domain (and in practice by the calendar span), not by the data.
    """
    a, b = dates.as_date(start), dates.as_date(end)
    iv = intervals.select(a.alias("a"), b.alias("b")).where(F.col("a") <= F.col("b"))
    marks = iv.select(F.explode(F.array(
        F.struct(F.col("a").alias("day"), F.lit(1).alias("delta")),
        F.struct(F.date_add("b", 1).alias("day"), F.lit(-1).alias("delta")),
    )).alias("m")).select("m.day", "m.delta")
    # Used three times below (calendar bounds, per-day join, year carry):
    # computed once and written to the shared checkpoint folder.
    deltas = checkpointed(marks.groupBy("day").agg(F.sum("delta").alias("delta")))

    calendar = (deltas.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
                .where(F.col("lo").isNotNull())
                .select(F.explode(dates.every_day("lo", "hi")).alias("day")))
    per_day = (calendar.join(deltas, "day", "left")
               .select("day", F.year("day").alias("yr"),
                       F.coalesce("delta", F.lit(0)).cast("bigint").alias("delta")))

    # Running sum in two levels: within each year (one window partition per
    # year), plus the net change of all earlier years (a window over a
    # per-year table of a few dozen rows).  Both tables are bounded by the
    # calendar span.
    # Every calendar year needs a carry, also a year no interval starts or
    # ends in, so the year sums run over the calendar, not over the deltas.
    years = per_day.groupBy("yr").agg(F.sum("delta").alias("year_delta"))
    carry = years.select(
        "yr",
        F.coalesce(F.sum("year_delta").over(
            Window.orderBy("yr").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("carry"))
    within = F.sum("delta").over(
        Window.partitionBy("yr").orderBy("day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # carry has one row per year: at most 9999 rows.
    return (per_day.withColumn("within", within)
            .join(F.broadcast(carry), "yr")
            .select("day", (F.col("carry") + F.col("within")).alias("n_open"))
            .where(F.col("n_open") > 0))


def expand_days(lines: DataFrame) -> DataFrame:
    return open_days(lines, "o_orderdate", "l_shipdate")


# -- bounds, flags, labels ---------------------------------------------------

def bounds(orders: DataFrame) -> DataFrame:                          # DT-14..17, 19, 20
    d = dates.as_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        dates.month_start(d).alias("month_start"),
        dates.year_start(d).alias("year_start"),
        dates.month_end(d).alias("month_end"),
        dates.year_end(d).alias("year_end"),
        dates.days_in_month(d).alias("days_in_month"),
    )


def period_flags(orders: DataFrame) -> DataFrame:                    # DT-21, 22, 31..33
    d = dates.as_date("o_orderdate")
    keys = [
        dates.weekday0(d).alias("weekday"),
        dates.is_month_start(d).alias("is_month_start"),
        dates.is_month_end(d).alias("is_month_end"),
        dates.is_year_start(d).alias("is_year_start"),
        dates.is_year_end(d).alias("is_year_end"),
        dates.is_quarter_end(d).alias("is_quarter_end"),
        dates.is_monday(d).alias("is_monday"),
        dates.is_thursday(d).alias("is_thursday"),
        dates.is_friday(d).alias("is_friday"),
        dates.is_week_end(d).alias("is_week_end"),
    ]
    return orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"))


def text_month_end(orders: DataFrame) -> DataFrame:                  # DT-23
    text = dates.label("o_orderdate", dates.DAY)
    return orders.select("o_orderkey", text.alias("day_text"),
                         dates.text_is_month_end(text).alias("text_month_end"))


def labels(orders: DataFrame) -> DataFrame:                          # DT-18, 24..26
    ts = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        dates.label(ts, dates.DAY).alias("day_label"),
        dates.label(ts, dates.MONTH).alias("month_label"),
        dates.label(ts, dates.YEAR).alias("year_label"),
        dates.label(ts, dates.ISO_DAY).alias("iso_label"),
        dates.label(ts, dates.SLASH_DAY).alias("slash_label"),
        dates.month_end_label(ts).alias("month_end_label"),
        dates.label(ts, "dd.MM.yyyy").alias("custom_label"),
    )


def parse_labels(orders: DataFrame) -> DataFrame:                    # DT-8, 27, 28
    text = (F.when(F.col("o_orderkey") % 10 == 0, F.lit(BAD_DAY_TEXT))
            .otherwise(dates.label("o_orderdate", dates.DAY)))
    staged = orders.select("o_orderkey", "o_orderdate", text.alias("day_text"))
    day = dates.parse_day("day_text", dates.DAY)
    return staged.select(
        "o_orderkey", "day_text",
        day.alias("parsed_day"),
        dates.parse_day(F.substr("day_text", F.lit(1), F.lit(6)), dates.MONTH).alias("parsed_month"),
        dates.parse_day(F.substr("day_text", F.lit(1), F.lit(4)), dates.YEAR).alias("parsed_year"),
        dates.parse_day(dates.label("o_orderdate", dates.ISO_DAY), dates.ISO_DAY).alias("iso_parsed"),
        dates.parse_add_months("day_text", dates.DAY, 1).alias("month_later_ts"),
        dates.parse_failed("day_text", day).alias("parse_failed"),
    )
