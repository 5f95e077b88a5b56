import math
import random

import numpy as np
import pandas as pd
import pytest

from couriermart.operators import profile
from messages import messages

SERIES = [3.5, -2.0, 8.25, 0.0, 41.0, 5.5, 7.0, 2.75]


def _frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def test_series_against_numpy(spark):
    (row,) = profile.numeric_summary(_frame(spark, [*SERIES, None, float("nan")]), ["x"]).collect()
    x = np.array(SERIES)
    q1, median, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (row["column"], row["count"]) == ("x", len(x))
    assert (row["min"], row["max"], row["range"]) == (x.min(), x.max(), x.max() - x.min())
    assert (row["q1"], row["median"], row["q3"], row["iqr"]) == pytest.approx((q1, median, q3, q3 - q1))
    assert (row["mean"], row["std_sample"], row["std_pop"]) == pytest.approx((x.mean(), x.std(ddof=1), x.std()))
    assert (row["outlier_low_fence"], row["outlier_high_fence"]) == pytest.approx((low, high))
    outside = int(((x < low) | (x > high)).sum())
    assert outside and (row["outlier_n_outliers"], row["outlier_share"]) == (outside, outside / len(x))


def test_kept_values_are_ranked_in_slices(spark):
    """The rows inside the brackets of one column are spread over several tasks."""
    rng = np.random.default_rng(5)
    zones = spark.createDataFrame(
        [("x", 1, float(v), 1) for v in rng.permutation(4000)], "column string, zone int, kept double, n long"
    )
    # So few rows would be merged into one slice otherwise.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = profile._ranked(zones, ["column"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    slices = [row["count"] for row in ranked.groupBy("slice").count().collect()]
    assert len(slices) > 1 and max(slices) < 4000 / 2
    assert all(row.first == int(row.kept) for row in ranked.select("first", "kept").collect())


@pytest.mark.parametrize(
    "values, expected",
    [
        (SERIES, "right"),
        ([-v for v in SERIES], "left"),
        ([1.0, 92, 93, 94, 95, 96, 97, 98, 99, 100], "left"),
        ([-5.0, 0, 0, 0, 50], "symmetric"),
        ([1.0, 2, 3], "symmetric"),
    ],
)
def test_skew(spark, values, expected):
    (row,) = profile.skew_class(profile.describe(_frame(spark, values), ["x"])).collect()
    assert row["skew"] == expected


def test_single_row_has_no_sample_deviation(spark):
    (row,) = profile.describe(_frame(spark, [7]), ["x"]).collect()
    assert row["std_sample"] is None and row["std_pop"] == 0.0
    assert row["q1"] == row["median"] == row["q3"] == 7.0


def test_column_without_values_keeps_its_row(spark):
    (row,) = profile.numeric_summary(_frame(spark, [None, None]), ["x"]).collect()
    assert row["count"] == 0 and row["median"] is None
    assert row["outlier_n_outliers"] == 0 and row["outlier_share"] == 0.0


def _pandas_quartiles(values):
    s = pd.Series(values, dtype="float64").dropna()
    return [s.quantile(q) for q in (0.25, 0.5, 0.75)]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 50, 997])
def test_quartiles_of_small_series(spark, size):
    rng = random.Random(size)
    values = [rng.choice([rng.uniform(-5, 5), rng.randint(0, 3), None]) for _ in range(size)] + [rng.random()]
    (row,) = profile.describe(_frame(spark, values), ["x"]).collect()
    assert [row["q1"], row["median"], row["q3"]] == pytest.approx(_pandas_quartiles(values))
    assert row["count"] == len([v for v in values if v is not None])


@pytest.mark.parametrize("shape", ["uniform", "lognormal", "one value half the time", "two values"])
def test_quartiles_beyond_the_sketch(spark, shape):
    """More rows than the sketch keeps, so the brackets are wider than a value."""
    rng = np.random.default_rng(7)
    n = 60_000
    values = {
        "uniform": lambda: rng.random(n),
        "lognormal": lambda: rng.lognormal(0, 3, n),
        "one value half the time": lambda: np.where(rng.random(n) < 0.5, 3.0, rng.random(n) * 6),
        "two values": lambda: np.where(rng.random(n) < 0.25, 1.0, 2.0),
    }[shape]()
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(7)
    (row,) = profile.summarise(profile.stacked(df, ["x"]), ["column"], accuracy=500).select(
        "q1", "median", "q3", "mean", "std_sample"
    ).collect()
    assert list(row)[:3] == pytest.approx(_pandas_quartiles(values), rel=1e-12)
    assert row["std_sample"] == pytest.approx(pd.Series(values).std(), rel=1e-9)


def test_segments_match_pandas(spark):
    rng = random.Random(3)
    rows = [
        {"country": rng.choice(["A", "A", "A", "B", None]), "price": rng.random(), "customer_id": i % 3}
        for i in range(400)
    ]
    df = messages(spark, rows)
    frame = pd.DataFrame(rows)
    expected = frame.groupby("country", dropna=False)["price"].agg(["count", "mean", "median", "sum"])
    got = profile.segment_stats(df, "country").collect()
    assert [row["count"] for row in got] == sorted(expected["count"], reverse=True)
    for row in got:
        want = expected.loc[row["country"] if row["country"] else np.nan]
        assert (row["count"], row["avg"], row["median"], row["total"]) == pytest.approx(tuple(want))
    assert sum(row["count"] for row in got) == len(rows)
    assert profile.segment_stats(df, "customer_id").count() == 3


def test_many_segments_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(profile, "BROADCAST_BYTES", 0)
    rows = [{"customer_id": i % 37, "price": (i * 7919 % 1000) / 1000} for i in range(900)]
    expected = pd.DataFrame(rows).groupby("customer_id")["price"].median()
    got = profile.segment_stats(messages(spark, rows), "customer_id").collect()
    assert {row["customer_id"]: row["median"] for row in got} == pytest.approx(expected.to_dict())


def test_dq_shares(spark):
    df = messages(spark, [{"sender": s} for s in (None, "not_defined", "Meta", None)])
    got = {r["column"]: r for r in profile.dq_metrics(df, ["sender", "country"]).collect()}
    assert (got["sender"].null_share, got["sender"].not_defined_share) == (0.5, 0.25)
    assert (got["country"].null_share, got["country"].not_defined_share) == (0.0, 0.0)
    assert got["sender"].deleted_share == 0.0


def test_dq_of_a_column_that_is_all_null(spark):
    df = messages(spark, [{"sender": None}, {"sender": None}])
    (row,) = profile.dq_metrics(df, ["sender"]).collect()
    assert (row.null_share, row.not_defined_share) == (1.0, 0.0)
    assert not math.isnan(row.deleted_share)
