"""Revenue over time, rankings, tiers, and load summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import DELIVERED
from ..functions.dates import days_between, month_start
from ..functions.scalars import label_null, percent
from ..operators.ranking import top_n_per_group
from ..sources.mart import active


def top_countries_by_month(messages: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` countries with the highest revenue in each month, ties by name.

    They are ranked by exact decimal sums; only what is shown is rounded.
    """
    per_country = messages.groupBy(month_start("sent_date").alias("month"), "country").agg(
        F.round(F.sum(F.col("price").cast("double")), 2).alias("revenue"),
        F.count("*").alias("sms"),
        F.sum(F.col("price").cast("decimal(18,9)")).alias("exact"),
    )
    order = [F.desc("exact"), F.asc_nulls_last("country")]
    top = top_n_per_group(per_country, ["month"], order, n)
    return top.select("month", "country", "revenue", "sms", "rnk").orderBy("month", "rnk")


def rank_countries(messages: DataFrame, n: int = 3, method: str = "rank") -> DataFrame:
    """The countries with the ``n`` highest message counts in each month; equal counts
    share a rank and are all kept."""
    per_country = messages.groupBy(month_start("sent_date").alias("month"), "country").agg(
        F.count("*").alias("sms")
    )
    top = top_n_per_group(per_country, ["month"], [F.desc("sms")], n, method)
    return top.select("month", "country", "sms", "rnk").orderBy("month", "rnk", F.asc_nulls_last("country"))


def load_summary(messages: DataFrame) -> DataFrame:
    """What a load has left: rows, period, deleted rows, delivered share of active rows."""
    is_active = F.col("deleted_at").isNull()
    delivered = F.col("delivery_status") == DELIVERED
    return messages.agg(
        F.count("*").alias("rows"),
        F.min("sent_date").alias("first_sent"),
        F.max("sent_date").alias("last_sent"),
        F.count("deleted_at").alias("soft_deleted"),
        percent(F.count("deleted_at"), F.count("*"), 2).alias("soft_deleted_pct"),
        percent(F.count_if(is_active & delivered), F.count_if(is_active), 2).alias("delivered_pct"),
    )


def currency_mix(messages: DataFrame) -> DataFrame:
    """Active messages per currency, NULL labelled, most common first."""
    return (
        active(messages)
        .groupBy(label_null("currency").alias("currency"))
        .agg(F.count("*").alias("sms"))
        .orderBy(F.desc("sms"), "currency")
    )


def row_count(messages: DataFrame) -> DataFrame:
    """The number of rows, deleted ones included."""
    return messages.agg(F.count("*").alias("rows"))


def period(messages: DataFrame) -> DataFrame:
    """The first and last sending time and the days between."""
    first, last = F.min("sent_date"), F.max("sent_date")
    return messages.agg(
        first.alias("first_sent"), last.alias("last_sent"), days_between(first, last).cast("long").alias("days")
    )
