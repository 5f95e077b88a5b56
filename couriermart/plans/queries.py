"""Every query by name: a function of a session and a data directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import MESSAGE_COLUMNS, NULLABLE_COLUMNS, ROLLUP_KEYS
from ..functions.scalars import named_uuid
from ..operators import checks, cohorts, profile, ranking, tariff
from ..operators.charts import Filters, apply_filters, chart_query, run_chart
from ..session import durable, scratch_path
from ..sources import formats, layout, reports
from ..sources.mart import active_mart, country_name, mart, table
from ..streaming.rollup import (
    ROLLUP_INPUTS, rollup_backfill, rollup_build, rollup_read, rollup_rebuild, rollup_stream,
)
from . import analytics, stored_queries
from .dashboard import CHARTS
from .report import NUMERIC_COLUMNS, full_report
from .stored import stored_mart, stored_rollup

Query = Callable[[SparkSession, str], DataFrame]

# What the dashboard user of ``filtered_chart`` has selected.
SELECTION = Filters(
    customers=(1001, 1004, 1007),
    sent_from=datetime(1996, 3, 1),
    sent_to=datetime(1999, 8, 31),
    equals={"currency": "RUB"},
)
# The customer and period of ``customer_period``.
PERIOD_CUSTOMER, PERIOD_FROM, PERIOD_TO = 1003, datetime(1997, 2, 10), datetime(1997, 5, 20)
SLICED_APPLICATION = "app-11"
REPORT_DATE = date(2025, 1, 1)
# Prices have seven decimals: one more keeps two engines' rounding from meeting a tie.
_PRICE_DIGITS = 8


def _chart(name: str) -> Query:
    chart = CHARTS[name]
    return lambda spark, sf_dir: run_chart(active_mart(spark, sf_dir, chart.columns), chart)


def _on_active(columns: list[str], build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(active_mart(spark, sf_dir, columns))


def _on_base(columns: list[str], build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(mart(spark, sf_dir, columns))


# --- charts and rollup ------------------------------------------------------


def filtered_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = CHARTS["delivery_rate_by_country"]
    rows = active_mart(spark, sf_dir, {*chart.columns, *SELECTION.columns, "message_id"})
    return chart_query(
        apply_filters(rows, SELECTION), ["count_messages", "delivery_rate_pct"], ["country"]
    )


def rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = rollup_build(mart(spark, sf_dir, ROLLUP_INPUTS))
    return built.withColumn("revenue", F.round("revenue", _PRICE_DIGITS))


def sms_by_day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = rollup_read(spark, stored_rollup(spark, sf_dir), ["day"])
    return merged.select("day", F.col("msgs").alias("count_messages")).orderBy("day")


def delivery_rate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = rollup_read(spark, stored_rollup(spark, sf_dir), [])
    rate = F.round(F.try_divide(F.lit(100.0) * F.col("delivrd"), F.col("msgs")), 2)
    return merged.select(rate.alias("delivery_rate_pct"))


def rollup_vs_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = rollup_read(spark, stored_rollup(spark, sf_dir))
    fresh = rollup_build(mart(spark, sf_dir, ROLLUP_INPUTS))
    return checks.rollup_differences(stored, fresh, ROLLUP_KEYS)


def rollup_stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a stream over the line items maintains it."""
    root = scratch_path(spark, "rollup-stream")
    messages = mart(spark, sf_dir, ROLLUP_INPUTS, stream=True)
    query = rollup_stream(messages, root, f"{root}/progress", available_now=True)
    query.awaitTermination()
    return rollup_read(spark, root).withColumn("revenue", F.round("revenue", _PRICE_DIGITS))


def _streamed(spark: SparkSession, root: str) -> None:
    stream = layout.stream_mart(spark, f"{root}/mart", files_per_batch=40)
    rollup_stream(stream, f"{root}/rollup", f"{root}/progress", available_now=True).awaitTermination()


def _day_totals(spark: SparkSession, root: str) -> DataFrame:
    merged = rollup_read(spark, f"{root}/rollup", ["day"])
    return merged.withColumn("revenue", F.round("revenue", _PRICE_DIGITS))


def rollup_backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the months backfilled, then the whole mart streamed in several micro-batches."""
    root = scratch_path(spark, "rollup-handover")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages.where("ym < 199800"), f"{root}/mart")
    rollup_backfill(layout.open_mart(spark, f"{root}/mart"), f"{root}/rollup")
    layout.append_new(messages, f"{root}/mart")
    _streamed(spark, root)
    return _day_totals(spark, root)


def rollup_reload_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that is streamed, replaced, and streamed on."""
    root = scratch_path(spark, "rollup-reload")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages.where("ym < 199600"), f"{root}/mart")
    _streamed(spark, root)
    layout.reload(messages, f"{root}/mart", f"{root}/rollup")
    _streamed(spark, root)
    return _day_totals(spark, root)


def rollup_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day rebuilt while its late messages have yet to stream."""
    root = scratch_path(spark, "rollup-rebuilt")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages.where("customer_id % 2 = 0"), f"{root}/mart")
    _streamed(spark, root)
    layout.append_new(messages, f"{root}/mart")
    rollup_rebuild(layout.open_mart(spark, f"{root}/mart"), f"{root}/rollup", [date(1997, 6, 1), date(1997, 6, 2)])
    _streamed(spark, root)
    return _day_totals(spark, root)


# --- cohorts ----------------------------------------------------------------


def cohort_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.cohort_grid(durable(cohorts.cohort_retention(active_mart(spark, sf_dir, ["receiver", "sent_date"]))))


# --- statistics -------------------------------------------------------------

# Quantiles are values of the data, or between two of them: they are exact, and rounding
# only removes the last bit. Means and deviations depend on the order of addition.
_EXACT = {"median", "min", "max", "range", "q1", "q3", "iqr", "low_fence", "high_fence"}
_EXACT_DIGITS, _SUM_DIGITS, _TOTAL_DIGITS = 11, 8, 2


def _digits(figure: str) -> int:
    if figure == "total":
        return _TOTAL_DIGITS
    return _EXACT_DIGITS if figure.removeprefix("outlier_") in _EXACT else _SUM_DIGITS


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded, as two engines that add in a different order need."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, _digits(name)) for name in doubles})


def _segments(by: str) -> Query:
    return _on_active([by, "price"], lambda messages: _rounded(profile.segment_stats(messages, by)))


def event_value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outliers and skew of a right-skewed column."""
    summary = profile.numeric_summary(table(spark, sf_dir, "events"), ["value"])
    skew = profile.skew_class(summary).select("column", "skew")
    return _rounded(summary.join(skew, "column"))


def dq_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlying delivery times and deleted rows of the base table."""
    messages = mart(spark, sf_dir, ["delivery_time", "deleted_at"])
    outliers = profile.iqr_outliers(messages, ["delivery_time"])
    deleted = messages.agg(F.count("deleted_at").alias("n")).scalar()
    return _rounded(outliers).withColumn("soft_deleted", deleted)


# --- checks -----------------------------------------------------------------


def _nation_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate card for the countries the data has: price, prefix and two operators each."""
    nations = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return nations.select(
        country_name().alias("country"),
        (0.03 + 0.001 * key).alias("base_price"),
        (key % 9 + 1).cast("string").alias("prefix"),
        F.array(
            F.concat(F.lit("op-"), (key % 16 + 1).cast("string")),
            F.concat(F.lit("op-"), ((key + 5) % 16 + 1).cast("string")),
        ).alias("operators"),
    ).where(F.col("country").isNotNull())


def checks_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "lineitem").count()  # read from the file footers
    return checks.smoke_checks(mart(spark, sf_dir, checks.SMOKE_COLUMNS), expected)


def checks_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.reconcile_checks(
        mart(spark, sf_dir), _nation_card(spark, sf_dir), ["country", "customer_id"]
    )


# --- tariff -----------------------------------------------------------------


def expected_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = active_mart(spark, sf_dir, ["message_id", "country", "segment_count", "price"])
    priced = tariff.tariff(messages, _nation_card(spark, sf_dir))
    return priced.withColumn("price", F.round("price", _PRICE_DIGITS))


def revenue_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue converted with one rate per currency and day, taken from the orders."""
    rates = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.when(F.col("o_orderpriority") == "1-URGENT", "EUR")
            .when(F.col("o_orderpriority") == "2-HIGH", "USD")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "RUB")
            .alias("currency"),
            F.to_date("o_orderdate").alias("day"),
        )
        .agg((F.max("o_totalprice") / 100000).alias("rate"))
    )
    messages = active_mart(spark, sf_dir, ["currency", "sent_date", "price"])
    return tariff.convert_revenue(messages, rates)


# --- layout -----------------------------------------------------------------


def _message_rows(df: DataFrame) -> DataFrame:
    return df.select(*MESSAGE_COLUMNS).withColumn("price", F.round("price", _PRICE_DIGITS))


def lookup_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message with the smallest id."""
    path = stored_mart(spark, sf_dir)
    (message_id,) = layout.open_mart(spark, path).agg(F.min("message_id")).first()
    return _message_rows(layout.lookup(spark, path, message_id))


def application_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _message_rows(layout.application_slice(spark, stored_mart(spark, sf_dir), SLICED_APPLICATION))


def customer_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = layout.customer_period(
        spark, stored_mart(spark, sf_dir), PERIOD_CUSTOMER, PERIOD_FROM, PERIOD_TO
    )
    return _message_rows(rows)


def month_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = layout.month_counts(layout.open_mart(spark, stored_mart(spark, sf_dir)))
    return counts.withColumn("ym", F.col("ym").cast("long"))


def append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored after a load and after its repetition."""
    path = scratch_path(spark, "append")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    layout.append_new(messages, path)
    first = layout.open_mart(spark, path).count()
    layout.append_new(messages, path)
    return layout.open_mart(spark, path).agg(
        F.count("*").alias("rows_after_second"),
        F.lit(first).cast("long").alias("rows_after_first"),
    )


def overwrite_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and rollup after loading twice with replacement."""
    root = scratch_path(spark, "reload")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    for _ in range(2):
        layout.reload(messages, f"{root}/mart", f"{root}/rollup")
    rows = layout.open_mart(spark, f"{root}/mart").agg(F.count("*").alias("n")).scalar()
    return rollup_read(spark, f"{root}/rollup").agg(
        F.max(rows).alias("rows"), F.sum("msgs").alias("rollup_msgs"), F.sum("delivrd").alias("rollup_delivrd")
    )


def format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As CSV, messages take seven times the bytes that they do in the mart, so slices are a quarter of a load's.
    slices = layout.month_slices(layout.open_mart(spark, stored_mart(spark, sf_dir)), slice_bytes=layout.SLICE_BYTES // 4)
    return formats.surviving_parts([part.select(*MESSAGE_COLUMNS) for part in slices], scratch_path(spark, "formats"))


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved report read back: one row per frame, subject and figure."""
    root = scratch_path(spark, "report")
    messages = layout.open_mart(spark, stored_mart(spark, sf_dir))
    reports.save_report(full_report(messages), root, REPORT_DATE)
    subjects = {
        "summary": "column", "price_by_country": "country", "price_by_customer": "customer_id", "dq": "column",
    }
    parts = []
    for name, subject in subjects.items():
        frame = reports.read_report(spark, root, name).drop("report_date")
        figures = [column for column in frame.columns if column != subject]
        wide = frame.select(
            F.col(subject).cast("string").alias("subject"),
            *[F.round(F.col(figure).cast("double"), _digits(figure)).alias(figure) for figure in figures],
        )
        long = wide.unpivot(["subject"], figures, "figure", "value")
        parts.append(long.select(F.lit(name).alias("frame"), "subject", "figure", "value"))
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined


QUERIES: dict[str, Query] = {
    **{name: _chart(name) for name in CHARTS},
    "filtered_chart": filtered_chart,
    "cohort_heatmap": _on_active(
        ["receiver", "sent_date"], lambda df: cohorts.cohort_heatmap(cohorts.cohort_retention(df))
    ),
    "cohort_grid": cohort_grid,
    "rollup_daily": rollup_daily,
    "sms_by_day_rollup": sms_by_day_rollup,
    "delivery_rate_rollup": delivery_rate_rollup,
    "rollup_vs_fact": rollup_vs_fact,
    "rollup_stream_daily": rollup_stream_daily,
    "rollup_backfill_then_stream": rollup_backfill_then_stream,
    "rollup_reload_stream": rollup_reload_stream,
    "rollup_rebuilt": rollup_rebuilt,
    "revenue_running_total": _on_active(
        ["sent_date", "price"], lambda df: ranking.running_total(df, "sent_date", "price")
    ),
    "revenue_mom": _on_active(
        ["sent_date", "price"], lambda df: ranking.period_growth(df, "sent_date", "price")
    ),
    "top3_countries_by_month": _on_active(["sent_date", "country", "price"], analytics.top_countries_by_month),
    "rank_countries": _on_active(["sent_date", "country"], analytics.rank_countries),
    "customer_tiers": _on_active(
        ["customer_id", "price"], lambda df: ranking.tiers(df, "customer_id", "price", 4)
    ),
    "cohort_retention": _on_active(["receiver", "sent_date"], cohorts.cohort_retention),
    "receiver_lifecycle": _on_active(["receiver", "sent_date"], cohorts.lifecycle),
    "describe_price": _on_active(["price"], lambda df: _rounded(profile.describe(df, ["price"]))),
    "describe_delivery_time": _on_active(
        ["delivery_time"], lambda df: _rounded(profile.describe(df, ["delivery_time"]))
    ),
    "iqr_outliers": _on_active(
        NUMERIC_COLUMNS, lambda df: _rounded(profile.iqr_outliers(df, NUMERIC_COLUMNS))
    ),
    "describe_sketched": lambda spark, sf_dir: _rounded(stored_queries.describe_sketched(spark, sf_dir)),
    "segment_by_country_sketched": lambda spark, sf_dir: _rounded(stored_queries.segment_by_country_sketched(spark, sf_dir)),
    "event_value_profile": event_value_profile,
    "segment_by_country": _segments("country"),
    "segment_by_customer": _segments("customer_id"),
    "skew_class": _on_active(
        NUMERIC_COLUMNS, lambda df: _rounded(profile.skew_class(profile.describe(df, NUMERIC_COLUMNS)))
    ),
    "dq_metrics": _on_base(
        [*NULLABLE_COLUMNS, "deleted_at"], lambda df: _rounded(profile.dq_metrics(df, NULLABLE_COLUMNS))
    ),
    "dq_board": dq_board,
    "load_summary": _on_base(["sent_date", "delivery_status", "deleted_at"], analytics.load_summary),
    "currency_mix": _on_base(["currency", "deleted_at"], analytics.currency_mix),
    "row_count": _on_base(["message_id"], analytics.row_count),
    "period": _on_base(["sent_date"], analytics.period),
    "expected_tariff": expected_tariff,
    "revenue_converted": revenue_converted,
    "delivery_time_by_status_class": _on_active(
        ["delivery_status", "delivery_time"], lambda df: _rounded(tariff.delivery_time_by_status_class(df))
    ),
    "message_key_hash": _on_active(
        ["message_id"], lambda df: df.select("message_id", named_uuid("message_id").alias("key"))
    ),
    "checks_smoke": checks_smoke,
    "checks_ranges": _on_base(
        ["segment_count", "attempt_number", "delivery_time", "price", "sent_date"],
        partial(checks.range_checks, sent_range=(datetime(1995, 1, 1), datetime(2001, 1, 1))),
    ),
    "checks_domain": _on_base(
        ["sender", "country", "delivery_status", "attempt_number", "currency", "receiver_operator", "direction"],
        checks.domain_checks,
    ),
    "checks_pairing": _on_base(["application_uuid", "customer_id"], checks.pairing_checks),
    "checks_shares": _on_base(
        ["delivery_status", "deleted_at", *NULLABLE_COLUMNS], checks.share_checks
    ),
    "checks_reconcile": checks_reconcile,
    "lookup_message": lookup_message,
    "application_slice": application_slice,
    "customer_period": customer_period,
    "month_partition_counts": month_partition_counts,
    "append_idempotent": append_idempotent,
    "overwrite_reload": overwrite_reload,
    "format_roundtrip": format_roundtrip,
    "report_roundtrip": report_roundtrip,
    **stored_queries.QUERIES,
}
