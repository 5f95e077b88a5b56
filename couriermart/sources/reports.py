"""Dated report tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def save_report(frames: Mapping[str, DataFrame], root: str, report_date: date) -> list[str]:
    """Write each frame to ``root/<name>/report_date=<date>``, replacing that date only."""
    paths = []
    for name, frame in frames.items():
        path = f"{root}/{name}/report_date={report_date.isoformat()}"
        frame.write.mode("overwrite").parquet(path)
        paths.append(path)
    return paths


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All dates of a report frame, with their ``report_date``."""
    return spark.read.parquet(f"{root}/{name}")
