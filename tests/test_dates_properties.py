"""Date builders against plain-Python computations on random batches (one
Spark job per batch of generated values)."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions import dates

DATES = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def add_months_py(d: dt.date, n: int) -> dt.date:
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


@SETTINGS
@given(st.lists(st.tuples(DATES, st.integers(-30, 30)), min_size=1, max_size=200))
def test_add_months_clamps_like_calendar(spark, rows):
    df = spark.createDataFrame(rows, "d date, n int")
    got = [r[0] for r in df.select(dates.add_months("d", df["n"])).collect()]
    assert got == [add_months_py(d, n) for d, n in rows]


@SETTINGS
@given(st.lists(st.tuples(DATES, DATES), min_size=1, max_size=200))
def test_months_over_and_day_gap(spark, rows):
    df = spark.createDataFrame(rows, "a date, b date")
    got = df.select(dates.months_over("a", "b"),
                    dates.whole_days_between(df["b"].cast("timestamp_ntz"),
                                             df["a"].cast("timestamp_ntz"))).collect()
    for (a, b), (months, gap) in zip(rows, got):
        want = (a.year - b.year) * 12 + a.month - b.month + (1 if a.day - b.day >= 1 else 0)
        assert months == str(want)
        assert gap == (a - b).days


@SETTINGS
@given(st.lists(DATES, min_size=1, max_size=200))
def test_text_month_end_and_bounds(spark, days):
    df = spark.createDataFrame([(d, d.strftime("%Y%m%d")) for d in days], "d date, s string")
    got = df.select(dates.text_is_month_end("s"), dates.is_month_end("d"),
                    dates.month_start("d"), dates.year_end("d"), dates.days_in_month("d"),
                    dates.weekday0("d")).collect()
    for d, (text_end, is_end, start, yend, dim, wd) in zip(days, got):
        last = calendar.monthrange(d.year, d.month)[1]
        assert is_end == (d.day == last)
        # the text table only differs from the calendar on 29 Feb texts, which
        # real dates never produce outside leap years
        assert text_end == (d.day == last)
        assert start == d.replace(day=1) and yend == dt.date(d.year, 12, 31) and dim == last
        assert wd == (d.isoweekday() % 7)


NEAR = st.dates(min_value=dt.date(2015, 12, 1), max_value=dt.date(2017, 2, 1))


@SETTINGS
@given(st.lists(st.tuples(NEAR, NEAR), min_size=1, max_size=60))
def test_open_days_sweep_equals_counting(spark, rows):
    from collections import Counter

    from tessera.plans import calendar_jobs as cal

    df = spark.createDataFrame(rows, "a date, b date")
    got = {r.day: r.n_open for r in cal.open_days(df, "a", "b").collect()}
    want = Counter()
    for a, b in rows:
        for k in range((b - a).days + 1):
            want[a + dt.timedelta(days=k)] += 1
    assert got == dict(want)


LEAPISH = st.dates(min_value=dt.date(2015, 1, 25), max_value=dt.date(2016, 4, 5))


@SETTINGS
@given(st.lists(st.tuples(LEAPISH, st.integers(1, 1000)), min_size=1, max_size=120))
def test_lookback_totals_equal_python(spark, rows):
    from collections import defaultdict

    from tessera.plans import calendar_jobs as cal

    orders = spark.createDataFrame(
        [(i, dt.datetime(d.year, d.month, d.day), float(p)) for i, (d, p) in enumerate(rows)],
        "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double")
    got = {r.order_day: tuple(r)[1:] for r in cal.lookback_totals(orders).collect()}
    tot, n = defaultdict(float), defaultdict(int)
    for d, p in rows:
        tot[d] += p
        n[d] += 1

    def back(d, months):
        return tot.get(add_months_py(d, months)) if add_months_py(d, months) in tot else None

    want = {d: (n[d], tot[d], tot.get(d - dt.timedelta(days=1)), back(d, -1), back(d, -12))
            for d in tot}
    assert got.keys() == want.keys()
    for d in want:
        assert got[d][0] == want[d][0]
        for g, w in zip(got[d][1:], want[d][1:]):
            assert (g is None and w is None) or abs(g - round(w, 2)) < 1e-6
