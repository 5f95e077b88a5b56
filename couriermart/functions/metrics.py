"""The named metrics every chart is built from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import DELIVERED
from .scalars import known_fraction, percent


@dataclass(frozen=True)
class Metric:
    """A named aggregate and the columns it reads."""

    name: str
    reads: tuple[str, ...]
    build: Callable[[], Column]

    def column(self) -> Column:
        return self.build().alias(self.name)


def _revenue() -> Column:
    return F.sum(F.col("price").cast("double"))


def _is_delivered() -> Column:
    return F.col("delivery_status") == DELIVERED


METRICS: dict[str, Metric] = {
    metric.name: metric
    for metric in (
        Metric("count_messages", ("message_id",), lambda: F.count("message_id")),
        Metric("count", (), lambda: F.count("*")),
        # Adds prices across currencies on purpose: there is no conversion.
        Metric("revenue", ("price",), lambda: F.round(_revenue(), 2)),
        # Of the rows whose status is known.
        Metric(
            "delivery_rate_pct", ("delivery_status",),
            lambda: F.round(100 * known_fraction(_is_delivered()), 2),
        ),
        Metric(
            "avg_delivery_time", ("delivery_time",),
            lambda: F.round(F.avg("delivery_time"), 0),
        ),
        # Of all rows, so this and the delivery rate add up to 100 only without NULL statuses.
        Metric(
            "failed_rate_pct", ("delivery_status",),
            lambda: percent(F.count_if(~_is_delivered()), F.count("*"), 2),
        ),
        # NULL when nothing was delivered.
        Metric(
            "cost_per_delivered", ("price", "delivery_status"),
            lambda: F.round(F.try_divide(_revenue(), F.count_if(_is_delivered())), 4),
        ),
        # Of the cohort dataset, which is aggregated already.
        Metric("retention_pct_max", ("retention_pct",), lambda: F.max("retention_pct")),
        Metric(
            "active_receivers_max", ("active_receivers",), lambda: F.max("active_receivers")
        ),
    )
}
KPI_METRICS = [
    "count_messages", "revenue", "delivery_rate_pct",
    "avg_delivery_time", "failed_rate_pct", "cost_per_delivered",
]


def metric_inputs(names: list[str]) -> list[str]:
    """The columns that the named metrics read."""
    return sorted({column for name in names for column in METRICS[name].reads})
