"""Small message frames: every column of the contract, with overridable values."""

from datetime import datetime, timedelta

from couriermart.contract import MESSAGE_COLUMNS, MESSAGE_SCHEMA

DEFAULTS = {
    "customer_id": 1001,
    "application_uuid": "app-1",
    "message_id": None,
    "sent_date": datetime(2025, 1, 15, 12),
    "sender": "Google",
    "receiver": "+7900",
    "country": "Russian Federation",
    "segment_count": 1,
    "delivery_status": "DELIVRD",
    "attempt_number": 1,
    "delivery_time": 700,
    "price": 0.5,
    "currency": "RUB",
    "receiver_operator": "MTS",
    "direction": 1,
    "created_at": None,
    "updated_at": None,
    "deleted_at": None,
}


def messages(spark, rows):
    """A frame of ``rows``; each gives only the columns that differ from the defaults."""
    filled = []
    for i, row in enumerate(rows):
        full = {**DEFAULTS, **row}
        full["message_id"] = full["message_id"] or f"m-{i}"
        full["created_at"] = full["created_at"] or full["sent_date"] + timedelta(seconds=1)
        full["updated_at"] = full["updated_at"] or full["sent_date"] + timedelta(minutes=5)
        filled.append(tuple(full[name] for name in MESSAGE_COLUMNS))
    return spark.createDataFrame(filled, MESSAGE_SCHEMA)
