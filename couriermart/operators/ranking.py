"""Running totals, period growth, top-N per group and tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .charts import GRAINS

RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def _per_period(df: DataFrame, ts: str, value: str, grain: str) -> DataFrame:
    return df.groupBy(GRAINS[grain](ts).alias(grain)).agg(
        F.sum(F.col(value).cast("double")).alias("amount"), F.count("*").alias("sms")
    )


def running_total(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Per day, the sum of ``value`` and the sum of all days so far.

    The ordered window has no partition key: it sees one row per calendar day.
    """
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = _per_period(df, ts, value, "day")
    return daily.select(
        "day",
        F.round("amount", 2).alias("revenue"),
        F.round(F.sum("amount").over(so_far), 2).alias("revenue_cumulative"),
    ).orderBy("day")


def period_growth(
    df: DataFrame, ts: str, value: str, grain: str = "month", with_next: bool = False
) -> DataFrame:
    """Per period, the sum of ``value``, that of the period before, and the growth in
    percent; ``with_next`` adds the sum of the period after. The first period's
    predecessor is 0, so its growth is NULL.

    The ordered window has no partition key: it sees one row per period.
    """
    in_order = Window.orderBy(grain)
    amount, before = F.col("amount"), F.col("before")
    periods = _per_period(df, ts, value, grain).withColumn("before", F.lag("amount", 1, 0.0).over(in_order))
    after = [F.round(F.lead("amount").over(in_order), 2).alias("next_revenue")] if with_next else []
    return periods.select(
        grain,
        F.round(amount, 2).alias("revenue"),
        F.round(before, 2).alias("prev_revenue"),
        F.round(100 * (amount - before) / F.nullif(before, F.lit(0.0)), 2).alias("mom_growth_pct"),
        *after,
    ).orderBy(grain)


def top_n_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, method: str = "row_number"
) -> DataFrame:
    """The rows of each group whose ``rnk`` is at most ``n``. ``rank`` and ``dense_rank``
    keep ties, ``row_number`` does not.

    Spark keeps only each task's own top ``n`` before it shuffles, so a large group is
    never moved whole.
    """
    ranked = df.withColumn("rnk", RANKS[method]().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rnk") <= n)


def tiers(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Per key, the summed ``value``, its tier 1..n of near-equal size and its dense rank,
    highest first; equal sums are ordered by key.

    There may be as many keys as there are customers, so no task orders them all. They
    are range-partitioned by (sum, key), which splits any run of equal sums, and kept;
    each slice is ranked on its own and shifted by what the slices before it hold.
    """
    amount = F.round(F.sum(F.col(value).cast("double")), 2)
    per_key = df.groupBy(key).agg(amount.alias("revenue"), F.count("*").alias("sms"))
    order = [F.desc("revenue"), F.asc(key)]
    sliced = durable(per_key.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()))

    # One row per slice from here to ``shifts``.
    sizes = sliced.groupBy("slice").agg(
        F.count("*").alias("rows"),
        F.count_distinct("revenue").alias("levels"),
        F.max("revenue").alias("first"),
        F.min("revenue").alias("last"),
    )
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shared = (F.lag("last").over(Window.orderBy("slice")) == F.col("first")).cast("long")
    new_levels = sizes.withColumn("new_levels", F.col("levels") - F.coalesce(shared, F.lit(0)))
    shifts = new_levels.select(
        "slice",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        (F.coalesce(F.sum("new_levels").over(earlier), F.lit(0)) - F.col("levels") + F.col("new_levels"))
        .alias("levels_before"),
        F.sum("rows").over(Window.partitionBy()).alias("all_rows"),
    )

    in_slice = Window.partitionBy("slice")
    position = F.col("rows_before") + F.row_number().over(in_slice.orderBy(*order))
    level = F.col("levels_before") + F.dense_rank().over(in_slice.orderBy(F.desc("revenue")))
    ranked = sliced.join(shifts, "slice").select(
        key, "revenue", "sms", "all_rows", position.alias("position"), level.cast("int").alias("revenue_rank")
    )
    # The first ``all_rows % n`` tiers hold one key more than the rest.
    small = F.floor(F.col("all_rows") / n)
    extra = F.col("all_rows") % n
    in_large = extra * (small + 1)
    tier = F.when(
        F.col("position") <= in_large, F.ceil(F.col("position") / (small + 1))
    ).otherwise(extra + F.ceil((F.col("position") - in_large) / F.greatest(small, F.lit(1))))
    return ranked.select(
        key, "revenue", "sms", tier.cast("int").alias("revenue_quartile"), "revenue_rank"
    ).orderBy(*order)
