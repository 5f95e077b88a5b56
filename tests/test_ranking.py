import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from couriermart.operators import ranking
from messages import messages


def test_first_period_has_no_growth(spark):
    rows = [
        {"sent_date": datetime(2025, 1, 5), "price": 0.4},
        {"sent_date": datetime(2025, 2, 5), "price": 0.5},
        {"sent_date": datetime(2025, 2, 6), "price": 0.1},
    ]
    first, second = ranking.period_growth(messages(spark, rows), "sent_date", "price").collect()
    assert (first.prev_revenue, first.mom_growth_pct) == (0.0, None)
    assert (second.prev_revenue, second.mom_growth_pct) == (0.4, 50.0)
    ahead = ranking.period_growth(messages(spark, rows), "sent_date", "price", with_next=True).collect()
    assert [r.next_revenue for r in ahead] == [0.6, None]


def test_running_total(spark):
    rows = [{"sent_date": datetime(2025, 1, d), "price": p} for d, p in ((2, 0.25), (1, 0.5), (2, 0.25))]
    got = ranking.running_total(messages(spark, rows), "sent_date", "price").collect()
    assert [(r.revenue, r.revenue_cumulative) for r in got] == [(0.5, 0.5), (0.5, 1.0)]


@pytest.mark.parametrize("method, kept", [("row_number", 2), ("rank", 3), ("dense_rank", 4)])
def test_top_n_ties(spark, method, kept):
    df = spark.createDataFrame([("g", v) for v in (9, 8, 8, 7)], "k string, v int")
    order = [F.desc("v")]
    n = 2 if method != "dense_rank" else 3
    assert ranking.top_n_per_group(df, ["k"], order, n, method).count() == kept


@pytest.mark.parametrize("keys, n", [(1, 4), (3, 4), (8, 4), (10, 4), (101, 4), (64, 7)])
def test_tiers_equal_windows_over_everything(spark, keys, n):
    """Against one ordered window, with long runs of equal sums."""
    rng = random.Random(keys)
    rows = [(k, rng.choice([1.0, 1.0, 2.0, rng.randint(0, 50) / 4])) for k in range(keys)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key bigint, value double")
    got = {r.key: (r.revenue_quartile, r.revenue_rank) for r in ranking.tiers(df, "key", "value", n).collect()}
    df.createOrReplaceTempView("tier_rows")
    expected = spark.sql(
        f"SELECT key, ntile({n}) OVER (ORDER BY value DESC, key) AS t, "
        "dense_rank() OVER (ORDER BY value DESC) AS r FROM tier_rows"
    ).collect()
    assert got == {r.key: (r.t, r.r) for r in expected}
