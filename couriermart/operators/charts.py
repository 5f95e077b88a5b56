"""Chart queries: named metrics, grouping, time grain and composable filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day, month_start
from ..functions.metrics import METRICS, metric_inputs

GRAINS = {"day": day, "month": month_start}


@dataclass(frozen=True)
class Filters:
    """What a dashboard user has selected. Anything left empty does not filter."""

    customers: Sequence[int] = ()
    sent_from: datetime | None = None
    sent_to: datetime | None = None
    equals: Mapping[str, object] = field(default_factory=dict)
    among: Mapping[str, Sequence] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        used = {*self.equals, *[name for name, values in self.among.items() if values]}
        if self.customers:
            used.add("customer_id")
        if self.sent_from or self.sent_to:
            used.add("sent_date")
        return sorted(used)


def apply_filters(messages: DataFrame, filters: Filters) -> DataFrame:
    """``messages`` narrowed by the customers, the time range (both ends included) and
    the clicked or selected categories, all at once; None among them selects NULL. On a month-partitioned table the range also
    limits the months that are read."""
    predicates: list[Column] = []
    if filters.customers:
        predicates.append(F.col("customer_id").isin(list(filters.customers)))
    months = F.col("ym") if "ym" in messages.columns else None
    for bound, is_lower in ((filters.sent_from, True), (filters.sent_to, False)):
        if bound is None:
            continue
        sent, month = F.col("sent_date"), bound.year * 100 + bound.month
        instant = F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
        predicates.append(sent >= instant if is_lower else sent <= instant)
        if months is not None:
            predicates.append(months >= month if is_lower else months <= month)
    for name, value in filters.equals.items():
        predicates.append(F.col(name).isNull() if value is None else F.col(name) == value)
    for name, values in filters.among.items():
        known = [value for value in values if value is not None]
        if values:
            chosen = F.col(name).isin(known)
            predicates.append(chosen if len(known) == len(values) else chosen | F.col(name).isNull())
    return messages.where(reduce(and_, predicates)) if predicates else messages


@dataclass(frozen=True)
class Chart:
    """A chart's data: which metrics, per which groups, over which rows."""

    metrics: tuple[str, ...]
    group_by: tuple[str, ...] = ()
    time_grain: str | None = None
    excluded: Mapping[str, tuple] = field(default_factory=dict)
    row_limit: int | None = None

    @property
    def columns(self) -> list[str]:
        used = {*metric_inputs(list(self.metrics)), *self.group_by, *self.excluded}
        if self.time_grain:
            used.add("sent_date")
        return sorted(used)

    def where(self) -> list[Column]:
        return [~F.col(name).isin(list(values)) for name, values in self.excluded.items()]


def chart_query(
    messages: DataFrame,
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    time_grain: str | None = None,
    where: Sequence[Column] = (),
    row_limit: int | None = None,
    order_desc: bool = True,
) -> DataFrame:
    """One aggregation over ``messages``.

    A time grain adds a leading ``day`` or ``month`` key and sorts by it; otherwise
    groups are sorted by the first metric, ties by the group's own key, NULL last. All
    groups are returned unless ``row_limit`` asks for the top ones.
    """
    rows = messages.where(reduce(and_, where)) if where else messages
    keys = [F.col(name) for name in group_by]
    if time_grain:
        keys.insert(0, GRAINS[time_grain]("sent_date").alias(time_grain))
    values = [METRICS[name].column() for name in metrics]
    if not keys:
        return rows.agg(*values)
    names = ([time_grain] if time_grain else []) + list(group_by)
    ties = [F.col(name).asc_nulls_last() for name in names]
    lead = F.col(metrics[0]).desc_nulls_last() if order_desc else F.col(metrics[0]).asc_nulls_last()
    order = ties if time_grain else [lead, *ties]
    ordered = rows.groupBy(*keys).agg(*values).orderBy(*order)
    return ordered if row_limit is None else ordered.limit(row_limit)


def run_chart(messages: DataFrame, chart: Chart, filters: Filters | None = None) -> DataFrame:
    """``chart`` over the rows that the user's filters leave."""
    rows = apply_filters(messages, filters) if filters else messages
    return chart_query(
        rows, chart.metrics, chart.group_by, chart.time_grain, chart.where(), chart.row_limit
    )
