"""The named metrics for users who write SQL: functions beside the views.

They are SQL functions of the session, so Spark expands them into the query and nothing
runs outside its plans. Aggregates stay in the query, as in
``delivery_rate(count_if(delivery_status = 'DELIVRD'), count(delivery_status))``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..contract import DELIVERED, IN_FLIGHT

_IN_FLIGHT = ", ".join(f"'{status}'" for status in IN_FLIGHT)
FUNCTIONS = {
    "status_class": (
        "status STRING", "STRING",
        f"CASE WHEN status = '{DELIVERED}' THEN 'delivered' WHEN status IN ({_IN_FLIGHT}) THEN 'in_flight' ELSE 'failed' END",
    ),
    "delivery_rate": ("delivered DOUBLE, known DOUBLE", "DOUBLE", "round(100 * try_divide(delivered, known), 2)"),
    "failed_rate": ("failed DOUBLE, total DOUBLE", "DOUBLE", "round(try_divide(100 * failed, total), 2)"),
    "cost_per_delivered": ("revenue DOUBLE, delivered DOUBLE", "DOUBLE", "round(try_divide(revenue, delivered), 4)"),
    "expected_price": (
        "base_price DOUBLE, segments BIGINT, unknown DOUBLE", "DOUBLE",
        "round(greatest(0.0D, least(1.0D, coalesce(base_price, unknown) * segments)), 4)",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session, in place of older ones of these names. Returns the names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
