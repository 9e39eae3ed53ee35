"""Calendar periods against day-by-day enumeration."""

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulier.errors import ContractError
from haulier.functions import periods as P

DAYS = st.dates(min_value=date(1900, 1, 1), max_value=date(2100, 12, 31))
GRANULARITIES = st.sampled_from(sorted(P.LEVELS))


def walk_back(day, granularity, count):
    """Starts of the last ``count`` periods, found by stepping one day at a time."""
    key = {"year": lambda d: d.year, "month": lambda d: (d.year, d.month), "day": lambda d: d}[granularity]
    starts = []
    while True:
        previous = day - timedelta(days=1)
        if key(previous) != key(day):
            starts.insert(0, day)
            if len(starts) == count:
                return starts
        day = previous


@settings(max_examples=60, deadline=None)
@given(DAYS, GRANULARITIES, st.integers(1, 15))
def test_window_lists_every_period_once(day, granularity, lookback):
    starts = walk_back(day, granularity, lookback)
    first, end = P.window_bounds(day, granularity, lookback)
    assert P.window_partitions(day, granularity, lookback) == [P.partition_path(s, granularity) for s in starts]
    assert first == starts[0] <= day < end
    assert P.period_start(end, granularity) == end
    assert P.period_start(end - timedelta(days=1), granularity) == starts[-1]


@settings(max_examples=60, deadline=None)
@given(DAYS, GRANULARITIES, st.integers(0, 400))
def test_shift_there_and_back(day, granularity, count):
    start = P.period_start(day, granularity)
    assert P.shift_periods(P.shift_periods(day, granularity, count), granularity, -count) == start


@pytest.mark.parametrize(
    ("day", "granularity", "lookback", "paths"),
    [
        (date(2024, 1, 31), "month", 2, ["year=2023/month=12", "year=2024/month=01"]),
        (date(2024, 3, 1), "day", 2, ["year=2024/month=02/day=29", "year=2024/month=03/day=01"]),
        (date(2026, 8, 22), "year", 3, ["year=2024", "year=2025", "year=2026"]),
        (date(2026, 8, 22), "month", 1, ["year=2026/month=08"]),
    ],
)
def test_window_edges(day, granularity, lookback, paths):
    assert P.window_partitions(day, granularity, lookback) == paths


def test_published_cutoffs():
    assert P.window_bounds(date(2026, 8, 18), "year", 3)[0] == date(2024, 1, 1)
    assert P.window_bounds(date(2026, 8, 18), "year", 19)[0] == date(2008, 1, 1)
    assert P.window_bounds(date(2026, 8, 22), "year", 17)[0] == date(2010, 1, 1)


def test_bad_arguments():
    with pytest.raises(ContractError):
        P.period_start(date(2024, 1, 1), "week")
    with pytest.raises(ContractError):
        P.window_bounds(date(2024, 1, 1), "day", 0)


@pytest.mark.parametrize("granularity", sorted(P.LEVELS))
def test_columns_agree_with_dates(spark, granularity):
    days = spark.sql("SELECT explode(sequence(DATE'2019-12-25', DATE'2021-01-05', INTERVAL 1 DAY)) AS d")
    rows = days.select(
        "d",
        P.period_start_column(F.col("d"), granularity).alias("start"),
        P.shift_periods_column(F.col("d"), granularity, -3).alias("earlier"),
        P.shift_periods_column(F.col("d"), granularity, 2).alias("later"),
        P.path_text(F.col("d"), granularity).alias("path"),
    ).collect()
    assert len(rows) == 378
    for row in rows:
        assert row.start == P.period_start(row.d, granularity)
        assert row.earlier == P.shift_periods(row.d, granularity, -3)
        assert row.later == P.shift_periods(row.d, granularity, 2)
        assert row.path == P.partition_path(row.d, granularity)


@pytest.mark.parametrize("granularity", sorted(P.LEVELS))
def test_window_frame(spark, granularity):
    frame = P.window_frame(spark, date(2024, 3, 1), granularity, 5).orderBy("period")
    assert [r.path for r in frame.collect()] == P.window_partitions(date(2024, 3, 1), granularity, 5)


def test_zoned_timestamps_are_dated_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        frame = spark.sql("SELECT TIMESTAMP'2023-12-31 23:30:00-03:00' AS z, TIMESTAMP_NTZ'2023-12-31 23:30:00' AS n")
        row = frame.select(
            *[P.as_utc_date(F.col(c), frame.schema[c].dataType).alias(c) for c in frame.columns]
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.z, row.n) == (date(2024, 1, 1), date(2023, 12, 31))
