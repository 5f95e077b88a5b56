"""Queries over the stored mart and rollup: hand-overs, deletes, compaction, lookups, set-up and SQL."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import MESSAGE_COLUMNS, load_field_specs
from ..operators import checks, profile, ranking, tariff
from ..operators.charts import Filters, apply_filters, chart_query
from ..session import scratch_path
from ..sources import layout
from ..sources.mart import active, active_mart, country_name, mart, table
from ..streaming.receivers import RECEIVERS, active_by_month, stored_retention
from ..streaming.rollup import (
    Partials, rollup_backfill, rollup_build, rollup_compact, rollup_expire, rollup_read, rollup_stream,
    write_covered, write_run,
)
from ..streaming.sketches import sketches, stored_brackets
from .datasets import ensure_datasets
from .report import NUMERIC_COLUMNS
from .sqlfunctions import register_functions
from .stored import stored_mart

# Prices have seven decimals: one more keeps two engines' rounding from meeting a tie.
_PRICE_DIGITS = 8
# What the dashboard user of ``filtered_among`` has selected; None selects NULL.
MANY = Filters(
    among={
        "country": ("NATION_3", "NATION_7", "NATION_11", None),
        "delivery_status": ("DELIVRD", "EXPIRED", None),
        "currency": ("EUR", "RUB"),
    }
)
LOOKED_UP = 1000
DELETED_AT = datetime(2001, 1, 1)


def follow(spark: SparkSession, root: str, files_per_batch: int = 40) -> None:
    """Stream what is new in the mart below ``root`` into its rollup."""
    stream = layout.stream_mart(spark, f"{root}/mart", files_per_batch=files_per_batch)
    rollup_stream(stream, f"{root}/rollup", f"{root}/progress", available_now=True).awaitTermination()


def day_totals(spark: SparkSession, root: str) -> DataFrame:
    return rollup_read(spark, f"{root}/rollup", ["day"]).withColumn("revenue", F.round("revenue", _PRICE_DIGITS))


def rollup_backfill_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill that died after all its writes but before its commit, repeated, and the mart streamed."""
    root = scratch_path(spark, "rollup-repeated")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages.where("ym < 199800"), f"{root}/mart")
    stored = layout.open_mart(spark, f"{root}/mart")
    write_run(rollup_build(stored), f"{root}/rollup")
    write_covered(stored, f"{root}/rollup")
    rollup_backfill(stored, f"{root}/rollup")
    layout.append_new(messages, f"{root}/mart")
    follow(spark, root)
    return day_totals(spark, root)


def rollup_soft_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads are streamed, then messages deleted in two goes, one before its load has streamed; no day is rebuilt."""
    root = scratch_path(spark, "rollup-deletes")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages.where("ym < 199700"), f"{root}/mart")
    follow(spark, root)
    layout.soft_delete(messages.where("customer_id = 1003 and currency = 'EUR'"), f"{root}/mart", DELETED_AT)
    layout.append_new(messages, f"{root}/mart")
    layout.soft_delete(messages.where("customer_id = 1005 or customer_id = 1003 and currency = 'EUR'"), f"{root}/mart", DELETED_AT)
    follow(spark, root)
    return rollup_read(spark, f"{root}/rollup").withColumn("revenue", F.round("revenue", _PRICE_DIGITS))


def rollup_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup of many small batches, compacted, its old folders deleted, and streamed on."""
    root = scratch_path(spark, "rollup-compacted")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages.where("ym < 199900"), f"{root}/mart")
    follow(spark, root, files_per_batch=10)
    rollup_compact(spark, f"{root}/rollup")
    rollup_expire(spark, f"{root}/rollup", keep_commits=1, older_than_s=0)
    layout.append_new(messages, f"{root}/mart")
    follow(spark, root)
    return day_totals(spark, root)


def _receivers_followed(spark: SparkSession, sf_dir: str) -> str:
    """Receiver partials of a mart that is backfilled, streamed, has late loads and deletes, and is compacted between."""
    root = scratch_path(spark, "receivers")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    held = f"{root}/receivers"

    def receivers_follow() -> None:
        stream = layout.stream_mart(spark, f"{root}/mart", files_per_batch=40)
        rollup_stream(stream, held, f"{root}/progress", available_now=True, kind=RECEIVERS).awaitTermination()

    # What was sent last is loaded first, so that cohorts move to earlier months.
    layout.append_new(messages.where("ym >= 199600"), f"{root}/mart")
    rollup_backfill(layout.open_mart(spark, f"{root}/mart"), held, RECEIVERS)
    receivers_follow()
    rollup_compact(spark, held, RECEIVERS)
    layout.soft_delete(messages.where("customer_id = 1003 and currency = 'EUR'"), f"{root}/mart", DELETED_AT)
    layout.append_new(messages, f"{root}/mart")
    layout.soft_delete(messages.where("customer_id = 1005 or customer_id = 1003 and currency = 'EUR'"), f"{root}/mart", DELETED_AT)
    receivers_follow()
    return held


def cohort_retention_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention from receiver partials that followed loads, late loads and deletes."""
    return stored_retention(spark, _receivers_followed(spark, sf_dir))


def active_receivers_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct receivers per month from the same partials."""
    return active_by_month(spark, _receivers_followed(spark, sf_dir))


def _sketched(spark: SparkSession, sf_dir: str, kind: Partials) -> tuple[DataFrame, str]:
    """The messages of a mart that is backfilled, streamed and has deletes, and the root of the sketches that followed it."""
    root = scratch_path(spark, "sketches")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    held = f"{root}/sketches"
    layout.append_new(messages.where("ym < 199600"), f"{root}/mart")
    rollup_backfill(layout.open_mart(spark, f"{root}/mart"), held, kind)
    layout.append_new(messages, f"{root}/mart")
    layout.soft_delete(messages.where("customer_id = 1005 or customer_id = 1003 and currency = 'EUR'"), f"{root}/mart", DELETED_AT)
    stream = layout.stream_mart(spark, f"{root}/mart", files_per_batch=40)
    rollup_stream(stream, held, f"{root}/progress", available_now=True, kind=kind).awaitTermination()
    return active(layout.open_mart(spark, f"{root}/mart")), held


def describe_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the numeric columns in one scan, by brackets from stored sketches."""
    kind = sketches(NUMERIC_COLUMNS)
    messages, held = _sketched(spark, sf_dir, kind)
    return profile.describe(messages, NUMERIC_COLUMNS, stored_brackets(spark, held, kind))


def segment_by_country_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices by country in one scan, by brackets from sketches per country."""
    kind = sketches(["price"], ["country"])
    messages, held = _sketched(spark, sf_dir, kind)
    brackets = stored_brackets(spark, held, kind, ["country"], profile.MEDIAN)
    return profile.segment_stats(messages, "country", brackets=brackets)


def lookup_thousand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages with the thousand smallest ids, found through the index."""
    path = stored_mart(spark, sf_dir)
    smallest = layout.open_mart(spark, path).select("message_id").orderBy("message_id").limit(LOOKED_UP)
    found = layout.lookup_many(spark, path, smallest).select(*MESSAGE_COLUMNS)
    return found.withColumn("price", F.round("price", _PRICE_DIGITS))


def filtered_among(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and rates by operator for several countries, statuses and currencies at once."""
    rows = active_mart(spark, sf_dir, {*MANY.columns, "message_id", "delivery_status", "receiver_operator"})
    return chart_query(apply_filters(rows, MANY), ["count_messages", "delivery_rate_pct"], ["receiver_operator"])


def revenue_next_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by month beside that of the months before and after."""
    return ranking.period_growth(active_mart(spark, sf_dir, ["sent_date", "price"]), "sent_date", "price", with_next=True)


def revenue_converted_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue converted with rates that are published on three days a month and hold until the next."""
    rates = table(spark, sf_dir, "orders").where(F.dayofmonth("o_orderdate").isin(1, 11, 21)).select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "EUR")
        .when(F.col("o_orderpriority") == "2-HIGH", "USD")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "RUB")
        .alias("currency"),
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_totalprice") / 100000).alias("rate"),
    )
    return tariff.convert_revenue(active_mart(spark, sf_dir, ["currency", "sent_date", "price"]), rates, as_of=True)


def setup_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything set up twice from a stored mart, then read through the views."""
    root = scratch_path(spark, "setup")
    layout.append_new(layout.open_mart(spark, stored_mart(spark, sf_dir)), f"{root}/mart")
    for _ in range(2):
        there = ensure_datasets(spark, f"{root}/mart", f"{root}/rollup")
    return spark.sql(
        """SELECT (SELECT count(*) FROM messages_mart) AS stored, (SELECT count(*) FROM messages_mart_active) AS active,
                  (SELECT sum(msgs) FROM messages_daily) AS rolled_up, (SELECT count(*) FROM cohort_retention) AS cohort_rows"""
    ).withColumn("views", F.lit(sum(there.values())).cast("long"))


def kpi_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's metrics by status class, written in SQL over the view of active messages."""
    register_functions(spark)
    messages = active_mart(spark, sf_dir, ["message_id", "price", "delivery_status", "delivery_time"])
    return spark.sql(
        """SELECT status_class(delivery_status) AS status_class, count(message_id) AS count_messages,
                  round(sum(price), 2) AS revenue,
                  delivery_rate(count_if(delivery_status = 'DELIVRD'), count(delivery_status)) AS delivery_rate_pct,
                  round(avg(delivery_time), 0) AS avg_delivery_time,
                  failed_rate(count_if(delivery_status <> 'DELIVRD'), count(*)) AS failed_rate_pct,
                  cost_per_delivered(sum(price), count_if(delivery_status = 'DELIVRD')) AS cost_per_delivered
           FROM {messages} GROUP BY ALL""",
        messages=messages,
    )


def checks_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains and ranges by field specs from a file, which lists the countries that the data has."""
    names = table(spark, sf_dir, "nation").select(country_name().alias("country")).where("country is not null")
    # One name per nation, and the sentinel.
    countries = sorted(row.country for row in names.distinct().collect())
    fields = {"country": {"values": countries}, "segment_count": {"min": 2, "max": 6}, "currency": {"values": []}}
    path = scratch_path(spark, "field-specs")
    spark.createDataFrame([(json.dumps({"fields": fields}),)], "value string").coalesce(1).write.text(path)
    specs = [spec for spec in load_field_specs(spark, path) if spec.name in ("country", "segment_count", "currency")]
    messages = mart(spark, sf_dir, ["country", "segment_count", "currency"])
    return checks.domain_checks(messages, specs).unionByName(checks.range_checks(messages, specs))


def checks_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that two loads have made while they wrote."""
    path = scratch_path(spark, "load-checks")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    for load in (messages.where("ym < 199700"), messages):
        layout.append_new(load, path)
    return checks.load_checks(spark, layout.load_record(spark, path), layout.stored_rows(spark, path), layout.stored_schema(spark, path))


QUERIES = {
    "checks_load": checks_load,
    "rollup_backfill_repeated": rollup_backfill_repeated,
    "rollup_soft_deletes": rollup_soft_deletes,
    "rollup_compacted": rollup_compacted,
    "cohort_retention_stored": cohort_retention_stored,
    "active_receivers_stored": active_receivers_stored,
    "lookup_thousand": lookup_thousand,
    "filtered_among": filtered_among,
    "revenue_next_month": revenue_next_month,
    "revenue_converted_asof": revenue_converted_asof,
    "setup_datasets": setup_datasets,
    "kpi_by_sql": kpi_by_sql,
    "checks_declared": checks_declared,
}
