"""The statistics and data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..contract import NULLABLE_COLUMNS
from ..operators.profile import report_frames

NUMERIC_COLUMNS = ["price", "delivery_time"]
SEGMENTS = ["country", "customer_id"]

# What the frames read, and what tells deleted rows.
REPORT_COLUMNS = list(dict.fromkeys([*NUMERIC_COLUMNS, *SEGMENTS, *NULLABLE_COLUMNS, "deleted_at"]))


def full_report(messages: DataFrame) -> dict[str, DataFrame]:
    """The report's four frames, from three scans. Data quality looks at all rows, the rest at active ones."""
    frames = report_frames(messages.select(*REPORT_COLUMNS), NUMERIC_COLUMNS, SEGMENTS, "price", NULLABLE_COLUMNS)
    return {
        "summary": frames[""],
        "price_by_country": frames["country"],
        "price_by_customer": frames["customer_id"],
        "dq": frames["dq"],
    }
