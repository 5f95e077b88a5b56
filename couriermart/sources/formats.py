"""The same messages in several file formats: size, time, and whether they survive."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, path_bytes

FORMATS = ("csv", "parquet", "orc")
# CSV has neither NULLs nor timestamps of its own: both are spelled out, times to the
# microsecond. An empty text is written in quotes, and blanks around a text are kept.
_OPTIONS = {
    "csv": {
        "header": "true",
        "nullValue": "\\N",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
}
PRICE_DIGITS = 2
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class FormatResult:
    """What storing the messages in a format took."""

    format: str
    path: str
    size_bytes: int
    write_s: float
    read_s: float


def _timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def fingerprint(messages: DataFrame, digits: int | None = PRICE_DIGITS) -> list:
    """Aggregates that change when a row or a value gets lost."""
    prices = F.sum("price")
    return [
        F.count("*").alias("rows"),
        (prices if digits is None else F.round(prices, digits)).alias("price_sum"),
        F.sum("segment_count").alias("segments"),
        F.sum("delivery_time").alias("delivery_time_sum"),
        F.count("sender").alias("senders"),
        F.count("country").alias("countries"),
        F.count("delivery_status").alias("statuses"),
        F.count("deleted_at").alias("deleted"),
        F.min("sent_date").alias("first_sent"),
        F.max("updated_at").alias("last_updated"),
    ]


def read_back(messages: DataFrame, result: FormatResult, **options: str) -> DataFrame:
    """The messages as read from ``result``'s files. A CSV file whose values may hold line
    breaks needs ``multiLine="true"``, which gives up reading parts of a file in parallel."""
    reader = messages.sparkSession.read.format(result.format).schema(messages.schema)
    return reader.options(**_OPTIONS.get(result.format, {}), **options).load(result.path)


def compare_formats(messages: DataFrame, root: str, formats: Sequence[str] = FORMATS) -> list[FormatResult]:
    """Write ``messages`` in each format below ``root`` and read every column back."""
    results = []
    for name in formats:
        path = f"{root}/{name}"
        write_s = _timed(
            lambda: messages.write.format(name).options(**_OPTIONS.get(name, {})).mode("overwrite").save(path)
        )
        written = FormatResult(name, path, path_bytes(messages.sparkSession, path), write_s, 0.0)
        read_s = _timed(
            lambda: read_back(messages, written).write.format("noop").mode("overwrite").save()
        )
        result = FormatResult(name, path, written.size_bytes, write_s, read_s)
        log.info("%s: %.1f MB, write %.2f s, read %.2f s", name, result.size_bytes / 2**20, write_s, read_s)
        results.append(result)
    return results


def against_csv(results: Sequence[FormatResult]) -> dict[str, dict[str, float]]:
    """How many times smaller, and faster to read, each format is than CSV."""
    csv = next(result for result in results if result.format == "csv")
    return {
        result.format: {
            "smaller": csv.size_bytes / result.size_bytes,
            "faster_read": csv.read_s / result.read_s,
        }
        for result in results
        if result.size_bytes and result.read_s
    }


def survivors(messages: DataFrame, results: Sequence[FormatResult], digits: int | None = PRICE_DIGITS) -> DataFrame:
    """Each format's fingerprint, one row per format; ``same_rows`` compares all columns of all rows. The sum of prices has
    ``digits`` decimals, or all if it is to be added to others."""
    # A hash skips NULLs, so each column also tells whether it is one; sums, unlike xor, keep equal rows.
    marked = [part for name in messages.columns for part in (F.col(name).isNull(), F.col(name))]
    every = F.sum(F.xxhash64(*marked).cast("decimal(28,0)"))
    written = messages.agg(every.alias("h")).first().h
    same = every.eqNullSafe(F.lit(written)).alias("same_rows")
    frames = [
        read_back(messages, result).agg(*fingerprint(messages, digits), same).select(F.lit(result.format).alias("format"), "*")
        for result in results
    ]
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def surviving_parts(parts: Sequence[DataFrame], root: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """``survivors`` of all the messages in ``parts``. Every part is written and read in every format, one after the other, and
    its files are deleted once they have been read: the disks hold one part in one format at a time."""
    spark, rows, schema = parts[0].sparkSession, [], None
    for number, part in enumerate(parts):
        for name in formats:
            results = compare_formats(part, f"{root}/{number}", [name])
            prints = survivors(part, results, digits=None)
            schema = prints.schema
            rows += prints.collect()
            for result in results:
                delete_path(spark, result.path)
    held = spark.createDataFrame(rows, schema)
    merged = {"first_sent": F.min, "last_updated": F.max, "same_rows": F.every}
    figures = [merged.get(name, F.sum)(name).alias(name) for name in schema.names[1:]]
    order = F.array_position(F.lit(list(formats)), F.col("format"))
    return held.groupBy("format").agg(*figures).orderBy(order).withColumn("price_sum", F.round("price_sum", PRICE_DIGITS))
