"""The dashboard's charts."""

from __future__ import annotations

from ..contract import DELIVERED
from ..functions.metrics import KPI_METRICS
from ..operators.charts import Chart

TOP = 10

CHARTS: dict[str, Chart] = {
    "sms_by_day": Chart(("count_messages",), time_grain="day"),
    "delivery_rate": Chart(("delivery_rate_pct",)),
    "revenue_total": Chart(("revenue",)),
    "top_countries": Chart(("count_messages",), ("country",), row_limit=TOP),
    "top_operators": Chart(("count_messages",), ("receiver_operator",), row_limit=TOP),
    "revenue_by_currency": Chart(("revenue",), ("currency",)),
    "failed_statuses": Chart(
        ("count_messages",), ("delivery_status",), excluded={"delivery_status": (DELIVERED,)}, row_limit=TOP
    ),
    "delivery_rate_by_operator": Chart(("delivery_rate_pct",), ("receiver_operator",), row_limit=TOP),
    "avg_delivery_time_by_operator": Chart(("avg_delivery_time",), ("receiver_operator",), row_limit=TOP),
    "delivery_rate_by_country": Chart(("delivery_rate_pct",), ("country",), row_limit=TOP),
    "failed_rate": Chart(("failed_rate_pct",)),
    "avg_delivery_time": Chart(("avg_delivery_time",)),
    "cost_per_delivered": Chart(("cost_per_delivered",)),
    "kpi_summary": Chart(tuple(KPI_METRICS)),
    "direction_split": Chart(("count_messages", "revenue", "delivery_rate_pct"), ("direction",)),
    "segment_distribution": Chart(("count_messages",), ("segment_count",)),
}
