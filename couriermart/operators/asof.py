"""Values that hold until the next one is known: validity intervals and joins at a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def validity(entries: DataFrame, keys: Sequence[str], since: str, value: str) -> DataFrame:
    """``keys, since, until, value``: each entry holds from its day up to that of the next entry of its key, the last one
    for good (``until`` NULL). Of several entries of one key and day the largest value counts; entries without day or
    value say nothing. The window sees one row per key and day."""
    daily = entries.where(F.col(since).isNotNull() & F.col(value).isNotNull()).groupBy(*keys, F.col(since).alias("since")).agg(
        F.max(value).alias(value)
    )
    return daily.withColumn("until", F.lead("since").over(Window.partitionBy(*keys).orderBy("since")))


def attach_as_of(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], on: str, value: str) -> DataFrame:
    """``rows`` with the ``value`` that holds on the day ``on``; NULL before the first entry, and for NULL keys or days.

    An interval is listed under each month it touches, so the join is one on key and month,
    and a day meets the few intervals of its month. Intervals end with the last day of
    ``rows``, which is one number.
    """
    last = rows.agg(F.max(on)).scalar()
    month = F.trunc(F.col(on), "month")
    pieces = (
        intervals.withColumn("__last", F.coalesce(F.date_sub("until", 1), F.greatest(last, F.col("since"))))
        .withColumn(
            "__month",
            F.explode(F.sequence(F.trunc("since", "month"), F.trunc("__last", "month"), F.expr("interval 1 month"))),
        )
        .select(*[F.col(key).alias(f"__{key}") for key in keys], "since", "__last", "__month", F.col(value).alias(value))
    )
    same = (month == F.col("__month")) & F.col(on).between(F.col("since"), F.col("__last"))
    for key in keys:
        same &= F.col(key) == F.col(f"__{key}")
    return rows.join(pieces, same, "left").select(*rows.columns, value)
