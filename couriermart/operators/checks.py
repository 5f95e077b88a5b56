"""Data checks. Each family is one aggregation, turned into one row per check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import (
    CURRENCIES, DELIVERED, FIELD_SPECS, MESSAGE_COLUMNS, MESSAGE_SCHEMA, NULLABLE_COLUMNS, FieldSpec, same_contract,
)
from ..functions.dates import days_between
from ..functions.scalars import fraction
from ..session import durable
from .joins import attach
from .tariff import card_violations

@dataclass(frozen=True)
class Check:
    """An observed number and the closed range it must be in; None means no bound."""

    name: str
    observed: Column
    low: float | None = None
    high: float | None = None


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run ``checks``, aggregates over ``df``, in one pass: ``check, observed, passed``."""
    observed = df.agg(*[check.observed.cast("double").alias(f"c{i}") for i, check in enumerate(checks)])

    def passed(i: int, check: Check) -> Column:
        value = F.col(f"c{i}")
        within = value.isNotNull()
        if check.low is not None:
            within &= value >= check.low
        if check.high is not None:
            within &= value <= check.high
        return within

    rows = [
        F.struct(
            F.lit(check.name).alias("check"),
            F.round(f"c{i}", 6).alias("observed"),
            F.coalesce(passed(i, check), F.lit(False)).alias("passed"),
        )
        for i, check in enumerate(checks)
    ]
    return observed.select(F.inline(F.array(*rows)))


def _active_only(value: Column) -> Column:
    return F.when(F.col("deleted_at").isNull(), value)


SMOKE_COLUMNS = ["customer_id", "sent_date", "country", "delivery_status", "price", "deleted_at"]


def smoke_checks(
    messages: DataFrame,
    expected_rows: int,
    days: tuple[int, int] = (330, 400),
    min_customers: int = 2,
) -> DataFrame:
    """Is the base table loaded and plausible?"""
    delivered = (F.col("delivery_status") == DELIVERED).cast("double")
    price = F.col("price").cast("double")
    span = days_between(F.min("sent_date"), F.max("sent_date"))
    return report(
        messages,
        [
            Check("row_count", F.count("*"), low=expected_rows * 99 // 100),
            Check("period_days", span, *days),
            Check("customers", F.count_distinct("customer_id"), low=min_customers),
            Check("status_known", F.count("delivery_status"), low=1),
            Check("country_known", F.count("country"), low=1),
            Check("revenue_base", F.round(F.sum(price), 2), low=0.01),
            Check("delivery_rate_pct", F.round(100 * F.avg(_active_only(delivered)), 2)),
            Check("revenue_active", F.round(F.sum(_active_only(price)), 2), low=0.01),
        ],
    )


def range_checks(messages: DataFrame, specs: Sequence[FieldSpec] = FIELD_SPECS, sent_range=None) -> DataFrame:
    """Values outside their field's closed range, which must be none. ``sent_range`` is
    the half-open interval that ``sent_date`` must be in."""
    checks = [
        Check(f"{spec.name}_range", F.count_if(~F.col(spec.name).between(spec.low, spec.high)), high=0)
        for spec in specs
        if spec.low is not None
    ]
    if sent_range:
        start, end = (F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz") for bound in sent_range)
        sent = F.col("sent_date")
        checks.append(Check("sent_date_range", F.count_if((sent < start) | (sent >= end)), high=0))
    return report(messages, checks)


def domain_checks(messages: DataFrame, specs: Sequence[FieldSpec] = FIELD_SPECS) -> DataFrame:
    """Values their field's list does not allow, which must be none. NULL is allowed."""
    return report(
        messages,
        [
            Check(f"{spec.name}_domain", F.count_if(~F.col(spec.name).isin(list(spec.values))), high=0)
            for spec in specs
            if spec.values
        ],
    )


def pairing_checks(messages: DataFrame) -> DataFrame:
    """Each application belongs to one customer."""
    pairs = messages.select("application_uuid", "customer_id").distinct()
    owners = pairs.groupBy("application_uuid").agg(F.count("*").alias("owners"))
    return report(
        owners,
        [
            Check("applications", F.count("*"), low=1),
            Check("shared_applications", F.count_if(F.col("owners") > 1), high=0),
        ],
    )


def share_checks(
    messages: DataFrame,
    delivered: tuple[float, float] = (0.75, 0.85),
    deleted: tuple[float, float] = (0.005, 0.03),
    leading_currency: str = "RUB",
) -> DataFrame:
    """Shares inside their bounds, NULLs present where they must be, and the leading
    currency ahead of the others."""
    others = [name for name in CURRENCIES if name != leading_currency]
    lead = F.count_if(F.col("currency") == leading_currency) - F.greatest(
        *[F.count_if(F.col("currency") == name) for name in others]
    )
    return report(
        messages,
        [
            Check("delivered_share", fraction(F.col("delivery_status") == DELIVERED), *delivered),
            Check("deleted_share", fraction(F.col("deleted_at").isNotNull()), *deleted),
            *[Check(f"{name}_nulls", F.count_if(F.col(name).isNull()), low=1) for name in NULLABLE_COLUMNS],
            Check(f"{leading_currency}_lead", lead, low=1),
        ],
    )


def reconcile_checks(messages: DataFrame, card: DataFrame, by: Sequence[str]) -> DataFrame:
    """Do the segment counts of each ``by`` column add up to the number of messages, does
    the schema match the contract, and do operators and receivers fit their country?

    The messages are read once, into one row per combination of the ``by`` columns.
    """
    combined = durable(card_violations(messages, card, by))
    segments = [
        combined.groupBy(name).agg(F.sum("count").alias("n")).agg(F.sum("n").alias("n")).scalar()
        for name in by
    ]
    return report(
        combined,
        [
            *[
                Check(f"{name}_difference", F.max(total) - F.sum("rows"), 0, 0)
                for name, total in zip(by, segments)
            ],
            Check("columns_matching", F.max(F.lit(_matching_columns(messages))), low=len(MESSAGE_COLUMNS)),
            Check("wrong_operator", F.sum("wrong_operator"), high=0),
            Check("wrong_prefix", F.sum("wrong_prefix"), high=0),
        ],
    )


def _matching_columns(messages: DataFrame) -> int:
    return len(MESSAGE_COLUMNS) if same_contract(messages.schema) else 0


def rollup_differences(
    rollup: DataFrame, fact: DataFrame, keys: Sequence[str], tolerance: float = 1e-9
) -> DataFrame:
    """Buckets where a stored rollup and a freshly computed one disagree, which must be
    none. Both sides are daily aggregates already. Sums of doubles depend on the order of
    addition, so revenue may differ by ``tolerance`` of its size."""
    left = rollup.select(*keys, *[F.col(c).alias(f"{c}_stored") for c in ("msgs", "delivrd", "revenue")])
    paired = attach(left, fact.select(*keys, "msgs", "delivrd", "revenue"), keys, "full")
    gap = F.abs(F.col("revenue_stored") - F.col("revenue"))
    differs = (
        ~F.col("msgs_stored").eqNullSafe(F.col("msgs"))
        | ~F.col("delivrd_stored").eqNullSafe(F.col("delivrd"))
        | F.coalesce(
            gap > tolerance * F.greatest(F.lit(1.0), F.abs("revenue")),
            ~F.col("revenue_stored").eqNullSafe(F.col("revenue")),
        )
    )
    return paired.agg(
        F.count("*").alias("buckets"),
        F.count_if(differs).alias("differences"),
        F.sum("msgs_stored").alias("msgs_rollup"),
        F.sum("msgs").alias("msgs_fact"),
    )


def load_metrics(specs: Sequence[FieldSpec] = FIELD_SPECS) -> list[Column]:
    """What a load counts while it writes: ``rows``, and for each field the values outside its range or list."""
    ranges = [(f"{spec.name}_range", ~F.col(spec.name).between(spec.low, spec.high)) for spec in specs if spec.low is not None]
    lists = [(f"{spec.name}_domain", ~F.col(spec.name).isin(list(spec.values))) for spec in specs if spec.values]
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(wrong).alias(name) for name, wrong in ranges + lists]]


def load_checks(spark: SparkSession, recorded: dict[str, int], stored: int, schema: T.StructType | None) -> DataFrame:
    """The checks that come with a load: are the rows that the loads have ``recorded`` all ``stored``, do the stored files
    have the contract's columns and types, and were all values allowed? None of them reads the messages."""
    columns = {field.name: field.dataType for field in schema} if schema else {}
    matching = sum(columns.get(field.name) == field.dataType for field in MESSAGE_SCHEMA)
    rows = recorded.get("rows", 0)
    found = [
        ("row_count", float(stored), stored >= rows > 0),
        ("columns_matching", float(matching), matching == len(MESSAGE_COLUMNS)),
        *[(name, float(n), n == 0) for name, n in sorted(recorded.items()) if name != "rows"],
    ]
    return spark.createDataFrame(found, "check string, observed double, passed boolean")
