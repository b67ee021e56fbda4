"""Business-date column builders (DT-1 .. DT-33).

Every builder takes and returns Columns, so it runs inside whole-stage
codegen over any table.  ``d`` is a DATE column, ``ts`` a TIMESTAMP_NTZ
column (time of day kept).  Month and year shifts clamp to the month end
(2019-01-31 + 1 month = 2019-02-28) and do not stick to it afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date text patterns.
DAY = "yyyyMMdd"
MONTH = "yyyyMM"
YEAR = "yyyy"
ISO_DAY = "yyyy-MM-dd"
SLASH_DAY = "yyyy/MM/dd"
CLOCK = "yyyy-MM-dd HH:mm:ss"

# Calendar field numbers -> (unit, multiplier) for shifts.
# 3/4 are week-of-year/-month, 5/6/7 day-of-month/-year/-week, 8 week-in-month,
# 9 AM/PM (half a day), 10/11 hour, 12 minute, 13 second, 14 millisecond.
CALENDAR_FIELDS = {
    1: ("YEAR", 1),
    2: ("MONTH", 1),
    3: ("WEEK", 1),
    4: ("WEEK", 1),
    5: ("DAY", 1),
    6: ("DAY", 1),
    7: ("DAY", 1),
    8: ("WEEK", 1),
    9: ("HOUR", 12),
    10: ("HOUR", 1),
    11: ("HOUR", 1),
    12: ("MINUTE", 1),
    13: ("SECOND", 1),
    14: ("MILLISECOND", 1),
}

# Month-day texts that always end a month (29 Feb included;
# 28 Feb only outside leap years).
MONTH_END_TEXTS = ("0131", "0229", "0331", "0430", "0531", "0630", "0731",
                   "0831", "0930", "1031", "1130", "1231")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _n(n) -> Column:
    return n if isinstance(n, Column) else F.lit(n)


def as_date(c) -> Column:
    return F.to_date(_c(c))


# -- shifts ----------------------------------------------------------------

def day_before(d) -> Column:                        # DT-1
    return F.date_sub(as_date(d), 1)


def day_after(d) -> Column:                         # DT-2
    return F.date_add(as_date(d), 1)


def add_days(d, n) -> Column:                       # DT-3
    return F.date_add(as_date(d), _n(n))


def add_days_ts(ts, n) -> Column:                   # DT-3, time kept
    return F.timestamp_add("DAY", _n(n), _c(ts))


def same_day_last_month(d) -> Column:               # DT-4, DT-5
    return F.add_months(as_date(d), -1)


previous_month = same_day_last_month


def add_months(d, n) -> Column:                     # DT-6
    return F.add_months(as_date(d), _n(n))


def add_months_ts(ts, n) -> Column:                 # DT-7
    return F.timestamp_add("MONTH", _n(n), _c(ts))


def add_years(d, n: int) -> Column:                 # DT-9 (29 Feb -> 28 Feb)
    return F.add_months(as_date(d), 12 * n)


def add_years_ts(ts, n) -> Column:
    return F.timestamp_add("YEAR", _n(n), _c(ts))


def add_field(ts, n: int, field: int) -> Column:    # DT-10
    """Add ``n`` of a Calendar field (numbered as in ``CALENDAR_FIELDS``)."""
    unit, mult = CALENDAR_FIELDS[field]
    return F.timestamp_add(unit, F.lit(n * mult), _c(ts))


def instant(d) -> Column:                           # DT-29
    """The same instant as a timestamp (a date is its midnight)."""
    return _c(d).cast("timestamp_ntz")


# -- shifts and bounds of instants: the time of day is kept ------------------

def day_before_ts(ts) -> Column:                    # DT-1
    return F.timestamp_add("DAY", F.lit(-1), instant(ts))


def day_after_ts(ts) -> Column:                     # DT-2
    return F.timestamp_add("DAY", F.lit(1), instant(ts))


def same_day_last_month_ts(ts) -> Column:           # DT-4, DT-5 (31 March -> 28 or 29 February)
    return F.timestamp_add("MONTH", F.lit(-1), instant(ts))


def _on_day(ts, day: Column) -> Column:
    """``ts`` moved to another day."""
    return F.timestamp_add("DAY", F.date_diff(day, as_date(ts)), instant(ts))


def month_start_ts(ts) -> Column:                   # DT-14
    return _on_day(ts, month_start(ts))


def year_start_ts(ts) -> Column:                    # DT-15
    return _on_day(ts, year_start(ts))


def month_end_ts(ts) -> Column:                     # DT-16, DT-17
    return _on_day(ts, month_end(ts))


def year_end_ts(ts) -> Column:                      # DT-19
    return _on_day(ts, year_end(ts))


# -- differences and ranges --------------------------------------------------

def whole_days_between(start, end) -> Column:       # DT-11
    """Whole 24-hour days from ``start`` to ``end``, truncated toward zero.

    TIMESTAMP_NTZ minus TIMESTAMP_NTZ is a day-time interval computed on the
    wall clock, with no session time zone (``timestampdiff`` would map both
    ends through the zone and lose an hour at a DST change); its DAY field is
    the whole days, truncated toward zero (-36 h -> -1)."""
    gap = _c(end).cast("timestamp_ntz") - _c(start).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), gap).cast("int")


def every_day(start, end) -> Column:                # DT-12
    """ARRAY of every day from start on, as many as whole days reach the end
    (of dates: both included); empty when end < start (explode it to get one
    row per day)."""
    a, days = as_date(start), whole_days_between(start, end)
    b = F.date_add(a, days)
    a = F.when(days >= 0, a)
    return F.when(a <= b, F.sequence(a, b, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>"))


def months_over(d1, d2) -> Column:                  # DT-13
    """Months of d1 over d2 as text: 12*dYear + dMonth, plus one when d1's day
    of month is later than d2's."""
    a, b = as_date(d1), as_date(d2)
    months = ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
              + F.when(F.dayofmonth(a) - F.dayofmonth(b) >= 1, 1).otherwise(0))
    return months.cast("string")


# -- period bounds -----------------------------------------------------------

def month_start(d) -> Column:                       # DT-14
    return F.trunc(as_date(d), "month")


def year_start(d) -> Column:                        # DT-15
    return F.trunc(as_date(d), "year")


def month_end(d) -> Column:                         # DT-16, DT-17
    return F.last_day(as_date(d))


def year_end(d) -> Column:                          # DT-19
    return F.make_date(F.year(as_date(d)), F.lit(12), F.lit(31))


def days_in_month(d) -> Column:                     # DT-20
    return F.dayofmonth(F.last_day(as_date(d)))


# -- period flags ------------------------------------------------------------

def is_month_start(d) -> Column:                    # DT-21
    return F.dayofmonth(as_date(d)) == 1


def is_month_end(d) -> Column:                      # DT-21
    return as_date(d) == F.last_day(as_date(d))


def is_year_start(d) -> Column:                     # DT-22
    return (F.month(as_date(d)) == 1) & (F.dayofmonth(as_date(d)) == 1)


def is_year_end(d) -> Column:                       # DT-22
    return (F.month(as_date(d)) == 12) & (F.dayofmonth(as_date(d)) == 31)


def weekday0(d) -> Column:                          # DT-31: Sunday 0 .. Saturday 6
    return F.dayofweek(as_date(d)) - 1


def is_monday(d) -> Column:                         # DT-32
    return weekday0(d) == 1


def is_thursday(d) -> Column:
    return weekday0(d) == 4


def is_friday(d) -> Column:
    return weekday0(d) == 5


def is_week_end(d) -> Column:                       # Sunday
    return weekday0(d) == 0


def is_quarter_end(d) -> Column:                    # DT-33
    return is_month_end(d) & (F.month(as_date(d)) % 3 == 0)


def is_leap_year(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def text_is_month_end(s) -> Column:                 # DT-23
    """Month end decided from ``yyyyMMdd`` text by table lookup: '0228' counts
    outside leap years only, '0229' always counts."""
    s = _c(s)
    from .fields import strict_int
    year = strict_int(F.substr(s, F.lit(1), F.lit(4)), "year")
    md = F.substr(s, F.lit(5), F.lit(4))
    return md.isin(*MONTH_END_TEXTS) | ((md == "0228") & ~is_leap_year(year))


# -- text ------------------------------------------------------------------

def label(d, pattern: str = DAY) -> Column:         # DT-24, DT-25, DT-26
    return F.date_format(_c(d), pattern)


def month_end_label(d, pattern: str = ISO_DAY) -> Column:   # DT-18
    return F.date_format(month_end(d), pattern)


def now_label(clock: Column | None = None) -> Column:   # DT-30
    """The wall clock in the session's time zone as text; ``clock`` stands in for the current instant."""
    return F.date_format(F.current_timestamp() if clock is None else clock, CLOCK)


def parse_day(s, pattern: str = DAY) -> Column:     # DT-27, DT-28
    """Text to DATE; malformed or impossible dates give NULL."""
    return F.try_to_date(_c(s), pattern)


def parse_ts(s, pattern: str) -> Column:            # DT-28
    """Text to TIMESTAMP_NTZ, wall clock exactly as written (no session time
    zone involved); malformed text gives NULL.  The lenient parse only
    validates, so the strict NTZ parse never sees a malformed text."""
    s = _c(s)
    return F.when(F.try_to_timestamp(s, F.lit(pattern)).isNotNull(),
                  F.to_timestamp_ntz(s, F.lit(pattern)))


def parse_add_months(s, pattern: str, n) -> Column:  # DT-8
    return add_months_ts(parse_ts(s, pattern), n)


def parse_failed(s, parsed: Column) -> Column:
    """Quarantine flag: text present but not a valid date."""
    return _c(s).isNotNull() & parsed.isNull()
