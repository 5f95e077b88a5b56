"""The stored mart and rollup of a data directory, loaded once per session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import path_exists, scratch_path
from ..sources.layout import write_mart
from ..sources.mart import mart
from ..streaming.rollup import ROLLUP_INPUTS, rollup_backfill

_loaded: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, kind: str, sf_dir: str, load) -> str:
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    # The scratch folder may have been released since.
    if key not in _loaded or not path_exists(spark, _loaded[key]):
        path = scratch_path(spark, kind)
        load(path)
        _loaded[key] = path
    return _loaded[key]


def stored_mart(spark: SparkSession, sf_dir: str) -> str:
    """Path of the stored mart of ``sf_dir``."""
    return _once(spark, "mart", sf_dir, lambda path: write_mart(mart(spark, sf_dir), path))


def stored_rollup(spark: SparkSession, sf_dir: str) -> str:
    """Root of the backfilled rollup of ``sf_dir``."""
    return _once(
        spark, "rollup", sf_dir, lambda root: rollup_backfill(mart(spark, sf_dir, ROLLUP_INPUTS), root)
    )
