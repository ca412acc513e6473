from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.intervals import interval
from tidemark.operators import timeseries as ts

T0 = dt.datetime(2024, 1, 1)


def _at(hours):
    return T0 + dt.timedelta(hours=hours)


@pytest.fixture
def gaps(spark):
    """Two rows in a range of six hours."""
    return spark.createDataFrame([(T0, 10.0), (_at(5), 20.0)], "ts timestamp_ntz, val double")


def _fill(df, **options):
    return ts.gapfill(df, "ts", "1 hour", T0, _at(6), {"v": "avg(val)"}, ordered=True, **options)


def test_gaps_are_null(gaps):
    assert [r.v for r in _fill(gaps).collect()] == [10.0, None, None, None, None, 20.0]


def test_gaps_carry_forward(gaps):
    assert [r.v for r in _fill(gaps, locf=["v"]).collect()] == [10.0] * 5 + [20.0]


def test_gaps_interpolate(gaps):
    filled = [r.v for r in _fill(gaps, interpolate=["v"]).collect()]
    assert filled == [10.0, 12.0, 14.0, 16.0, 18.0, 20.0]


def test_whole_numbers_interpolate_whole(spark):
    df = spark.createDataFrame([(T0, 1), (_at(3), 3)], "ts timestamp_ntz, val int")
    out = ts.gapfill(df, "ts", "1 hour", T0, _at(4), {"v": "max(val)"}, interpolate=["v"],
                     ordered=True)
    assert [r.v for r in out.collect()] == [1, 1, 2, 3]


def test_series_without_rows(spark, gaps):
    empty = gaps.filter("val > 100")
    assert [r.v for r in _fill(empty).collect()] == [None] * 6
    keyed = ts.gapfill(empty.withColumn("k", F.lit(1)), "ts", "1 hour", T0, _at(6),
                       {"v": "avg(val)"}, "k")
    assert keyed.count() == 0


def test_unaligned_range_starts_at_its_bucket(gaps):
    out = ts.gapfill(gaps, "ts", "1 hour", T0 + dt.timedelta(minutes=30), _at(2), {"n": "count(*)"},
                     ordered=True)
    assert [(r.bucket, r.n) for r in out.collect()] == [(T0, None), (_at(1), None)]


def test_gapfill_arguments(gaps):
    with pytest.raises(ValueError):
        ts.gapfill(gaps, "ts", "1 hour", _at(2), _at(1), {"v": "avg(val)"})
    with pytest.raises(ValueError):
        _fill(gaps, locf=["unknown"])
    with pytest.raises(ValueError):
        _fill(gaps, locf=["v"], interpolate=["v"])


@pytest.mark.parametrize("options", [
    {}, {"locf": ["v"]}, {"interpolate": ["v"]}, {"locf": ["v"], "treat_null_as_missing": True}])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_sliced_series_equals_plain(spark, monkeypatch, options, by):
    rng = random.Random(4)
    data = [(T0 + dt.timedelta(minutes=rng.randrange(6000)), rng.choice("ab"),
             rng.choice([None, 1.0, 2.0, 5.0])) for _ in range(120)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, val double")

    def run():
        return rows_of(ts.gapfill(df, "ts", "7 minutes", T0, _at(100), {"v": "max(val)"}, by,
                                  **options))

    plain = run()
    monkeypatch.setattr(ts, "SLICE_BUCKETS", 16)
    monkeypatch.setattr(ts, "BLOCK", 5)
    assert run() == plain
    keys = len({k for _, k, _ in data}) if by else 1
    assert len(plain) == keys * len({r[0] for r in plain})


def test_month_buckets_and_null_time(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1999, 12, 31, 23), 1), (dt.datetime(2024, 3, 31, 12, 1, 2), 2), (None, 3)],
        "ts timestamp_ntz, v int")
    out = rows_of(ts.time_bucket_agg(df, "ts", "2 months", {"n": "count(*)"}))
    assert out == [(dt.datetime(1999, 11, 1), 1), (dt.datetime(2024, 3, 1), 1), (None, 1)]
    from tidemark.functions.timebucket import time_bucket

    column = df.select(time_bucket(F.col("ts"), "2 months").alias("b"))
    assert [r.b for r in column.collect()] == [
        dt.datetime(1999, 11, 1), dt.datetime(2024, 3, 1), None]


def test_buckets_before_the_origin(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 7, 20, 20, 17),)], "ts timestamp_ntz")
    assert ts.time_bucket_agg(df, "ts", "1 week", {"n": "count(*)"}).first()["bucket"] == (
        dt.datetime(1969, 7, 14))


def test_intervals():
    assert interval("2 weeks").micros == 14 * 86_400_000_000
    assert interval("1 Year").months == 12
    for bad in ("", "5", "-1 day", "1 fortnight", "0 days", "1 day; drop"):
        with pytest.raises(ValueError):
            interval(bad)
    assert interval("1 month").before(dt.datetime(2024, 3, 31)) == dt.datetime(2024, 2, 29)


def test_moving_window_equals_brute_force(spark):
    rng = random.Random(7)
    data = [(i, rng.choice("ab"), T0 + dt.timedelta(seconds=rng.randrange(4000)), rng.randrange(9))
            for i in range(300)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp_ntz, v int")
    got = {r.id: r.s for r in ts.moving_window(
        df, "ts", "10 seconds", {"s": "sum(v)"}, "k").collect()}
    frame = dt.timedelta(seconds=10)
    want = {i: sum(v2 for _, k2, t2, v2 in data if k2 == k and t - frame <= t2 <= t)
            for i, k, t, _ in data}
    assert got == want


@pytest.mark.parametrize("rows_per_part", [2, 5, 10_000])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_moving_measures_equal_brute_force(spark, rows_per_part, by):
    """Whatever the number of parts of a frame; ties and frame borders included."""
    rng = random.Random(8)
    data = [(i, rng.choice(["a", None]), T0 + dt.timedelta(milliseconds=500 * rng.randrange(400)),
             rng.choice([None, *range(9)])) for i in range(250)]
    df = spark.createDataFrame([*data, (900, "a", None, 1), (901, "a", None, 2)],
                               "id int, k string, ts timestamp_ntz, v int")
    got = {r.id: (r.n, r.s, r.low, r.high) for r in ts.moving_measures(
        df, "ts", "10 seconds", {"n": ("count", F.lit(1)), "s": ("sum", "v"), "low": ("min", "v"),
                                 "high": ("max", "v")}, by, rows_per_part).collect()}
    frame = dt.timedelta(seconds=10)
    for i, k, t, _ in data:
        near = [v2 for _, k2, t2, v2 in data if (not by or k2 == k) and t - frame <= t2 <= t]
        there = [v for v in near if v is not None]
        assert got[i] == (len(near), sum(there) if there else None, min(there, default=None), max(there, default=None))
    assert got[900] == got[901] == (2, 3, 1, 2) and len(got) == 252


def test_moving_measures_spread_a_hot_key(spark):
    """More rows in the same time make more, shorter parts."""
    df = spark.range(4000).select((F.lit(T0).cast("timestamp") + F.make_interval(secs=F.col("id") / 1000)).alias("ts"))
    plan = ts.moving_measures(df, "ts", "1 second", {"n": ("count", F.lit(1))}, rows_per_part=100)
    assert plan.filter("n > 1001").count() == 0 and plan.filter("n = 1001").count() == 3000
    assert "/ 100000)" in plan._jdf.queryExecution().optimizedPlan().toString().replace("100000.0", "100000")


def test_moving_measures_of_a_dense_frame_take_linear_time(spark):
    """One series, 50 000 rows in every frame: a running aggregate per row, not the frame again."""
    df = spark.range(200_000).select("id", (F.lit(T0).cast("timestamp") + F.make_interval(secs=F.col("id") / 1000)).alias("ts"))
    for rows_per_part in (1_000_000, 7_000):
        got = ts.moving_measures(df, "ts", "50 seconds", {"n": ("count", F.lit(1)), "s": ("sum", "id"),
                                                          "low": ("min", "id"), "high": ("max", "id")},
                                 rows_per_part=rows_per_part)
        first = F.greatest(F.col("id") - 50_000, F.lit(0))
        wrong = got.filter((F.col("low") != first) | (F.col("high") != F.col("id")) | (F.col("n") != F.col("id") - first + 1)
                           | (F.col("s") != (F.col("id") + first) * F.col("n") / 2))
        assert got.count() == 200_000 and wrong.count() == 0


def test_last_per_key_is_repeatable_without_tie_break(spark):
    rows = [(1, T0, "x"), (1, T0, "y")]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "k int, ts timestamp_ntz, v string").coalesce(1)
        assert ts.last_per_key(df, "k", "ts").first()["v"] == "y"


def test_last_per_key_counts_null_time_as_newest(spark):
    df = spark.createDataFrame(
        [(1, T0, "old"), (1, None, "undated"), (2, T0, "a"), (2, _at(1), "b")],
        "k int, ts timestamp_ntz, v string")
    assert rows_of(ts.last_per_key(df, "k", "ts", columns=["v"])) == [(1, "undated"), (2, "b")]
