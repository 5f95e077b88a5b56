"""Brackets from stored sketches: one scan, and the same statistics whether they fit or not."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from couriermart.operators import profile
from couriermart.session import scratch_path
from couriermart.sources import layout
from couriermart.sources.mart import active
from couriermart.streaming import rollup
from couriermart.streaming.sketches import sketches, stored_brackets
from messages import messages

COLUMNS = ["price", "delivery_time"]


def rows(spark, first, count, price=lambda i: i * 37 % 1009 / 8, country=lambda i: ["A", "B", None][i % 3]):
    return messages(
        spark,
        [
            {
                "message_id": f"m-{i}", "sent_date": datetime(2025, 1 + i % 3, 5), "price": price(i), "country": country(i),
                "delivery_time": None if i % 5 == 0 else i % 97,
            }
            for i in range(first, first + count)
        ],
    )


def as_rows(frame, key):
    return {row[key]: [pytest.approx(x) if isinstance(x, float) else x for x in row] for row in frame.collect()}


def same(spark, held, kind, fact):
    assert as_rows(profile.describe(fact, COLUMNS, stored_brackets(spark, held, kind)), "column") == as_rows(
        profile.describe(fact, COLUMNS), "column"
    )


def test_statistics_follow_loads_and_deletes(spark):
    root, kind = scratch_path(spark, "sketches-test"), sketches(COLUMNS, ["country"])
    mart, held = f"{root}/mart", f"{root}/held"

    def follow():
        stream = layout.stream_mart(spark, mart)
        rollup.rollup_stream(stream, held, f"{root}/progress", available_now=True, kind=kind).awaitTermination()
        fact = active(layout.open_mart(spark, mart))
        same(spark, held, kind, fact)
        prices = stored_brackets(spark, held, sketches(COLUMNS, ["country"]), ["country", "column"], profile.MEDIAN)
        prices = prices.where(F.col("column") == "price").drop("column")
        assert as_rows(profile.segment_stats(fact, "country", brackets=prices), "country") == as_rows(
            profile.segment_stats(fact, "country"), "country"
        )

    layout.append_new(rows(spark, 0, 300), mart)
    assert rollup.rollup_backfill(layout.open_mart(spark, mart), held, kind)
    follow()
    layout.append_new(rows(spark, 300, 200), mart)
    rollup.rollup_compact(spark, held, kind)
    follow()
    # All that was cheap goes: the sketches still hold it, the statistics do not.
    layout.soft_delete(rows(spark, 0, 500).where("price < 90"), mart, datetime(2025, 6, 1))
    follow()


def summary(values, brackets=None):
    return as_rows(profile.summarise(values, ["column"], brackets=brackets), "column")


@pytest.mark.parametrize("edges", [[0.0] * 6, [1e9] * 6, [10.0, 11.0, 20.0, 21.0, 30.0, 31.0], None])
def test_brackets_that_miss(spark, edges):
    """Wrong, empty and absent brackets, also of keys that have no rows, change nothing."""
    frame = spark.range(4000).select((F.col("id") * 7919 % 4001).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    values = profile.stacked(frame, ["x", "y"])
    brackets = spark.createDataFrame([("x", edges), ("gone", [1.0] * 6)], "column string, edges array<double>")
    assert summary(values, brackets) == summary(values)
    assert summary(values, brackets.limit(0)) == summary(values)
    assert summary(values.limit(0), brackets) == {}


def test_good_brackets_spare_a_scan(spark, monkeypatch):
    kind, root = sketches(["price"]), scratch_path(spark, "sketches-scan")
    fact = rows(spark, 0, 5000)
    rollup.rollup_add(fact, root, 0, kind=kind)
    brackets = stored_brackets(spark, root, kind)
    expected = as_rows(profile.describe(fact, ["price"]), "column")
    monkeypatch.setattr(profile, "_sketch", lambda *_: pytest.fail("the values were sketched again"))
    assert as_rows(profile.describe(fact, ["price"], brackets), "column") == expected
