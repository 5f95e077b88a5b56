"""Temp views for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cohorts import cohort_retention
from ..sources.layout import ensure_mart
from ..sources.mart import active
from ..streaming.rollup import rollup_backfill, rollup_read

VIEWS = ["messages_mart", "messages_mart_active", "cohort_retention", "messages_daily"]


def register_views(messages: DataFrame, rollup_root: str | None = None) -> None:
    """``messages_mart``, ``messages_mart_active`` without deleted rows, the
    ``cohort_retention`` dataset, and ``messages_daily`` when a rollup is named."""
    messages.createOrReplaceTempView("messages_mart")
    kept = active(messages)
    kept.createOrReplaceTempView("messages_mart_active")
    cohort_retention(kept).createOrReplaceTempView("cohort_retention")
    if rollup_root:
        rollup_read(messages.sparkSession, rollup_root).createOrReplaceTempView("messages_daily")


def ensure_datasets(spark: SparkSession, mart_path: str, rollup_root: str) -> dict[str, bool]:
    """Set everything up that is not there yet: an empty mart, the rollup of messages that
    were stored before it, and the views. Running it again changes nothing. Returns which
    views exist."""
    stored = ensure_mart(spark, mart_path)
    rollup_backfill(stored, rollup_root)
    register_views(stored, rollup_root)
    return {name: spark.catalog.tableExists(name) for name in VIEWS}
