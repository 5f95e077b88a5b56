"""One key holds a third of all rows, and every result is still whole."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from couriermart.operators import cohorts, profile, ranking
from couriermart.operators.charts import chart_query
from couriermart.session import scratch_path
from couriermart.sources import layout
from couriermart.streaming.rollup import rollup_build, rollup_merge
from messages import messages

N = 6000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    start = datetime(2025, 1, 1)
    made = []
    for i in range(N):
        hot = i % 3 == 0
        made.append(
            {
                "message_id": f"id-{i}",
                "customer_id": 1 if hot else rng.randint(2, 400),
                "receiver": "+hot" if hot else f"+{rng.randint(1, 900)}",
                "country": "Hotland" if hot else f"C{rng.randint(1, 30)}",
                "price": 0.25 if hot else round(rng.random(), 4),
                "sent_date": datetime(2025, 5, 5, 5) if hot else start + timedelta(hours=rng.randint(0, 8000)),
            }
        )
    return made


@pytest.fixture(scope="module")
def df(spark, rows):
    return messages(spark, rows).repartition(12, "message_id")


@pytest.fixture(scope="module")
def frame(rows):
    return pd.DataFrame(rows)


def test_chart(df, frame):
    got = {r.country: r.count_messages for r in chart_query(df, ["count_messages"], ["country"]).collect()}
    assert got == frame["country"].value_counts().to_dict()


@pytest.mark.parametrize("broadcast", [50000, 0])
def test_segment_medians(df, frame, monkeypatch, broadcast):
    monkeypatch.setattr(profile, "BROADCAST_BYTES", broadcast)
    got = {r.customer_id: (r["count"], r["median"]) for r in profile.segment_stats(df, "customer_id").collect()}
    expected = frame.groupby("customer_id")["price"].agg(["count", "median"])
    assert {k: v[0] for k, v in got.items()} == expected["count"].to_dict()
    assert {k: v[1] for k, v in got.items()} == pytest.approx(expected["median"].to_dict())


def test_salted_lookup_spreads_the_hot_key(df, monkeypatch):
    monkeypatch.setattr(profile, "BROADCAST_BYTES", 0)
    values = profile.stacked(df, ["price"], ["country"])
    small = values.select("country").distinct()
    placed = profile._attach_sized(values, small, ["country"])
    assert placed.count() == N
    assert "salt" not in placed.columns


def test_tiers(df, frame):
    revenue = frame.groupby("customer_id")["price"].sum().round(2)
    ordered = sorted(revenue.items(), key=lambda item: (-item[1], item[0]))
    got = [(r.customer_id, r.revenue) for r in ranking.tiers(df, "customer_id", "price", 4).collect()]
    assert got == [(key, pytest.approx(value)) for key, value in ordered]


def test_cohorts(df, frame):
    retention = cohorts.cohort_retention(df).collect()
    months = frame.assign(month=frame["sent_date"].dt.to_period("M"))[["receiver", "month"]].drop_duplicates()
    assert sum(r.active_receivers for r in retention) == len(months)
    assert sum(r.cohort_size for r in retention if r.month_index == 0) == months["receiver"].nunique()
    stages = cohorts.lifecycle(df).collect()
    assert sum(r.receivers for r in stages) == months["receiver"].nunique()


def test_rollup(df):
    assert sum(r.msgs for r in rollup_merge(rollup_build(df), ["day"]).collect()) == N


def test_layout_spreads_the_hot_month(spark, df):
    path = scratch_path(spark, "skew-layout")
    layout.write_mart(df, path, partitions=12)
    stored = layout.open_mart(spark, path)
    assert stored.count() == N
    hot_month = stored.where("ym = 202505")
    assert len(hot_month.inputFiles()) > 2
