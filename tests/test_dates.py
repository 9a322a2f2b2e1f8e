import sqlite3
from datetime import date, datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldledger.functions import dates
from fieldledger.plans.billing import cents

C = F.col


def test_calendar_steps_roll_over_month_ends(spark):
    rows = [
        ("2023-01-31", "monthly", 1, "2023-03-03"),
        ("2024-01-31", "monthly", 1, "2024-03-02"),
        ("2023-03-31", "monthly", 3, "2023-07-01"),
        ("2023-08-31", "monthly", 18, "2025-03-03"),
        ("2024-02-29", "yearly", 1, "2025-03-01"),
        ("2024-02-29", "monthly", 0, "2024-02-29"),
        ("2024-02-29", "weekly", 2, "2024-03-14"),
        ("2024-02-29", "daily", 1, "2024-03-01"),
        ("2024-02-29", "monthly", -1, None),
        ("2024-02-29", "daily", -1, None),
        ("2024-02-29", "monthly", None, None),
        ("2024-02-29", None, 1, None),
        (None, "monthly", 1, None),
    ]
    df = spark.createDataFrame(rows, "d string, f string, n long, want string")
    got = df.select(dates.iso(dates.cadence_add(C("d").cast("date"), C("f"), C("n"))).alias("got"), "want")
    assert [r for r in got.collect() if r.got != r.want] == []


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4_000_000_000), st.integers(0, 60)), min_size=50, max_size=80))
def test_calendar_steps_agree_with_sqlite(spark, cases):
    con = sqlite3.connect(":memory:")
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i long, ts long, n long")
    day = dates.utc_date(C("ts"))
    cols = [dates.iso(dates.cadence_add(day, F.lit(f), C("n"))).alias(f) for f in ("daily", "monthly", "yearly")]
    for row in df.select("i", *cols).collect():
        ts, n = cases[row.i]
        want = con.execute(
            f"SELECT date(?, 'unixepoch', '+{n} days'), date(?, 'unixepoch', '+{n} months'), date(?, 'unixepoch', '+{n} years')",
            (ts, ts, ts),
        ).fetchone()
        assert (row.daily, row.monthly, row.yearly) == want


def test_results_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(993945600,), (-1,), (1710064800,)], "ts long")
    shown = df.select(
        dates.utc_day(C("ts")), dates.iso(dates.local_date(C("ts"), dates.PACIFIC)), dates.clock_text(C("ts"), dates.PACIFIC), dates.clock_text(C("ts"))
    )
    answers = []
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        answers.append([tuple(r) for r in shown.collect()])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert answers[0] == answers[1] == answers[2]
    assert answers[0][0] == ("2001-07-01", "2001-06-30", "2001-06-30 17:00:00", "2001-07-01 00:00:00")
    # Clocks went forward at 10:00 UTC that day.
    assert answers[0][2][2] == "2024-03-10 03:00:00"


def test_whole_days_cut_toward_zero(spark):
    df = spark.createDataFrame([(100 - 90000,), (100 - 86500,), (86399,), (86400,), (None,)], "s long")
    assert [r[0] for r in df.select(dates.whole_days(C("s"))).collect()] == [-1, -1, 0, 1, None]


def test_rounding_is_half_away_from_zero_and_ignores_addition_noise(spark):
    df = spark.createDataFrame([(2.675, 2), (1.005, 2), (0.125, 2), (2.5, 0), (-2.5, 0), (1657588.7449999999, 2)], "x double, n int")
    got = [df.where(C("x") == x).select(cents(C("x"), n)).first()[0] for x, n in [tuple(r) for r in df.collect()]]
    assert got == [2.68, 1.01, 0.13, 3.0, -3.0, 1657588.75]


def test_clock_of_a_bad_value_is_null(spark):
    df = spark.createDataFrame([("12",), ("soon",), (None,)], "t string")
    assert [r[0] for r in df.select(dates.clock_text(C("t"))).collect()] == ["1970-01-01 00:00:12", None, None]


def test_years_become_ranges(spark):
    edges = [dates.year_start(y) + d for y in (2023, 2024, 2026) for d in (-1, 0)]
    df = spark.createDataFrame([(e,) for e in edges], "ts long")
    test = dates.in_years(C("ts"), (2024, 2023, 2025))
    assert [r[0] for r in df.where(test).collect()] == [edges[1], edges[2], edges[3], edges[4]]
    gap = dates.in_years(C("ts"), (2022, 2024))
    assert [r[0] for r in df.where(gap).collect()] == [edges[0], edges[3]]


def test_month_shift_of_the_clock():
    con = sqlite3.connect(":memory:")
    start = datetime(2023, 8, 31, 13, 5, tzinfo=timezone.utc)
    for k in range(0, 400, 7):
        as_of = int((start + timedelta(days=k)).timestamp())
        want = con.execute("SELECT CAST(strftime('%s', ?, 'unixepoch', '+18 months') AS INTEGER)", (as_of,)).fetchone()[0]
        assert dates.shift_months(as_of, 18) == want


def test_day_start_epoch(spark):
    row = spark.range(1).select(dates.day_start_epoch(F.lit(date(2001, 7, 1)))).first()
    assert row[0] == 993945600
