from datetime import datetime

from pyspark.sql import functions as F

from couriermart.functions.metrics import KPI_METRICS
from couriermart.operators.charts import Filters, apply_filters, chart_query
from couriermart.sources.mart import active
from messages import messages


def test_null_status_counts_in_one_rate_only(spark):
    df = messages(spark, [{"delivery_status": status} for status in ("DELIVRD", "UNDELIV", None)])
    (row,) = chart_query(df, KPI_METRICS).collect()
    assert row.delivery_rate_pct == 50.0
    assert row.failed_rate_pct == 33.33
    assert row.count_messages == 3
    assert row.cost_per_delivered == 1.5


def test_nothing_delivered_has_no_cost(spark):
    df = messages(spark, [{"delivery_status": "UNDELIV"}])
    assert chart_query(df, ["cost_per_delivered"]).first()[0] is None


def test_metrics_of_no_rows(spark):
    (row,) = chart_query(messages(spark, []), KPI_METRICS).collect()
    assert row.count_messages == 0
    assert row.revenue is None and row.failed_rate_pct is None


def test_deleted_rows_are_not_active(spark):
    df = messages(spark, [{}, {"deleted_at": datetime(2025, 2, 1)}])
    assert active(df).count() == 1


def test_top_keeps_order_limit_and_null_group(spark):
    rows = [{"country": c} for c in ("B", "A", "A", None, "B", "C")]
    got = chart_query(messages(spark, rows), ["count_messages"], ["country"], row_limit=3).collect()
    assert [tuple(r) for r in got] == [("A", 2), ("B", 2), ("C", 1)]
    ascending = chart_query(messages(spark, rows), ["count_messages"], ["country"], order_desc=False).first()
    assert tuple(ascending) == ("C", 1)


def test_all_groups_are_returned(spark):
    many = spark.range(12_000).selectExpr("cast(id as string) as country", "'m' as message_id")
    assert chart_query(many, ["count_messages"], ["country"]).count() == 12_000


def test_selected_values(spark):
    rows = [{"country": c, "currency": m} for c, m in (("A", "EUR"), ("B", "USD"), (None, "EUR"), ("C", None))]
    df = messages(spark, rows)
    kept = lambda **among: sorted(str(r.country) for r in apply_filters(df, Filters(among=among)).collect())
    assert kept(country=["A", "B"]) == ["A", "B"]
    assert kept(country=["A", None]) == ["A", "None"]
    assert kept(country=["A", "B", None], currency=["EUR"]) == ["A", "None"]
    assert kept(country=[]) == ["A", "B", "C", "None"]
    assert Filters(among={"country": ["A"], "sender": []}).columns == ["country"]


def test_not_in_drops_null(spark):
    df = messages(spark, [{"delivery_status": s} for s in ("DELIVRD", "SENT", None)])
    got = chart_query(df, ["count_messages"], ["delivery_status"], where=[~F.col("delivery_status").isin("DELIVRD")])
    assert [tuple(r) for r in got.collect()] == [("SENT", 1)]


def test_time_grain_sorts_by_time(spark):
    rows = [{"sent_date": datetime(2025, m, d, 23, 59)} for m, d in ((2, 1), (1, 31), (2, 1))]
    days = chart_query(messages(spark, rows), ["count_messages"], time_grain="day").collect()
    assert [(str(r.day), r.count_messages) for r in days] == [("2025-01-31", 1), ("2025-02-01", 2)]
    months = chart_query(messages(spark, rows), ["count_messages"], ["country"], time_grain="month").collect()
    assert [str(r.month) for r in months] == ["2025-01-01", "2025-02-01"]


def test_filters_compose_and_empty_means_all(spark):
    rows = [
        {"customer_id": c, "sent_date": datetime(2025, 1, d), "currency": cur}
        for c, d, cur in ((1, 1, "RUB"), (1, 2, "USD"), (2, 2, "RUB"), (3, 3, None))
    ]
    df = messages(spark, rows)
    assert apply_filters(df, Filters()).count() == 4
    assert apply_filters(df, Filters(customers=(1, 2))).count() == 3
    both_ends = Filters(sent_from=datetime(2025, 1, 2), sent_to=datetime(2025, 1, 3))
    assert apply_filters(df, both_ends).count() == 3
    assert apply_filters(df, Filters((1, 2), datetime(2025, 1, 2), None, {"currency": "RUB"})).count() == 1
    assert apply_filters(df, Filters(equals={"currency": None})).count() == 1
