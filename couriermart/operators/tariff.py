"""Rate-card lookups: expected price, valid operators and phone prefixes, conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import DEFAULT_BASE_PRICE, RATE_CARD, RATE_CARD_SCHEMA
from ..functions.scalars import clip, status_class
from .asof import attach_as_of, validity
from .profile import summarise


def rate_card(spark: SparkSession) -> DataFrame:
    """The fixed rate card: one row per country."""
    return spark.createDataFrame(RATE_CARD, RATE_CARD_SCHEMA)


def tariff(messages: DataFrame, card: DataFrame, default_price: float = DEFAULT_BASE_PRICE) -> DataFrame:
    """``messages`` with the price the card expects: base price times segments, held in
    [0, 1], four digits. A country the card does not list has the default base price."""
    prices = card.select("country", "base_price")
    base = F.coalesce(F.col("base_price"), F.lit(default_price))
    expected = F.round(clip(base * F.col("segment_count"), 0.0, 1.0), 4)
    return messages.join(prices, "country", "left").select(
        *messages.columns, expected.alias("expected_price")
    )


def card_violations(messages: DataFrame, card: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per ``by`` columns, how many messages name an operator their country does not have,
    or a receiver whose number does not start with the country's prefix, of how many
    ``rows``, and how many carry a price. NULLs are not violations."""
    rules = card.select("country", "prefix", "operators")
    wrong_operator = ~F.array_contains("operators", F.col("receiver_operator"))
    wrong_prefix = ~F.startswith(F.col("receiver"), F.concat(F.lit("+"), F.col("prefix")))
    return messages.join(rules, "country", "left").groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count("price").alias("count"),
        F.count_if(wrong_operator).alias("wrong_operator"),
        F.count_if(wrong_prefix).alias("wrong_prefix"),
    )


def delivery_time_by_status_class(messages: DataFrame) -> DataFrame:
    """Count, average and median delivery time per status class."""
    values = messages.select(
        status_class("delivery_status").alias("status_class"),
        F.col("delivery_time").cast("double").alias("value"),
    )
    stats = summarise(values, ["status_class"], {"median": 0.5})
    return stats.select("status_class", "count", F.col("mean").alias("avg"), "median")


def convert_revenue(messages: DataFrame, rates: DataFrame, as_of: bool = False) -> DataFrame:
    """Revenue per currency, as sent and converted with the rate of the sending day.

    ``rates`` holds rows of ``currency``, ``day`` and ``rate``, one each unless ``as_of``; with it, a day without a
    rate takes the last one before it. Prices are summed per currency
    and day before the join, so it never sees more than a row per rate.
    """
    daily = messages.groupBy("currency", F.to_date("sent_date").alias("day")).agg(
        F.sum(F.col("price").cast("double")).alias("revenue"), F.count("*").alias("sms")
    )
    if as_of:
        rated = attach_as_of(daily, validity(rates, ["currency"], "day", "rate"), ["currency"], "day", "rate")
    else:
        rated = daily.join(rates, ["currency", "day"], "left")
    return rated.groupBy("currency").agg(
        F.sum("sms").alias("sms"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
        F.round(F.sum(F.col("revenue") * F.col("rate")), 2).alias("revenue_converted"),
        F.sum(F.when(F.col("rate").isNull(), F.col("sms")).otherwise(0)).alias("sms_without_rate"),
    ).orderBy(F.asc_nulls_last("currency"))
