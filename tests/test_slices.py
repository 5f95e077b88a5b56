"""Loads, deletes and the index of ids by slices: whole, once each, with little on the disks at a time."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from couriermart.contract import MESSAGE_COLUMNS
from couriermart.session import scratch_path, source_bytes
from couriermart.sources import commits, ids, layout
from messages import messages
from support import plan_of


@pytest.fixture
def rows(spark):
    """Files of 300 messages of six months, two of them without a time, one id in three rows."""
    path = scratch_path(spark, "slices-source")
    made = [
        {"message_id": f"m-{i}" if i % 100 else "same", "customer_id": 1001 + i % 4, "sent_date": datetime(2024, 10 + i % 3, 1 + i % 28) if i % 2 else datetime(2025, 1 + i % 3, 31 if i % 3 != 1 else 28)}
        for i in range(300)
    ]
    lost = F.col("message_id").isin("m-7", "m-8")
    frame = messages(spark, made)
    frame.withColumn("sent_date", F.when(~lost, F.col("sent_date"))).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def equal(a, b):
    a, b = (df.select(*MESSAGE_COLUMNS) for df in (a, b))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_slices_hold_every_message_once(spark, rows):
    dated = layout._with_month(rows)
    for slice_bytes, most in ((10**12, 1), (source_bytes(rows) // 3, 4), (1, 6)):
        parts = layout.month_slices(dated, slice_bytes=slice_bytes)
        assert len(parts) == most
        months = [{row[0] for row in part.select("ym").distinct().collect()} for part in parts]
        assert sum(len(own) for own in months) == 7 and None in months[0]
        assert sum(part.count() for part in parts) == 300
    assert len(layout.month_slices(layout._with_month(messages(spark, [])))) == 1


def test_a_load_shuffles_a_slice_at_a_time(spark, rows, monkeypatch):
    monkeypatch.setattr(layout, "SLICE_BYTES", source_bytes(rows) // 3)
    written, write = [], layout._write_slice
    monkeypatch.setattr(layout, "_write_slice", lambda part, *args: written.append(part.count()) or write(part, *args))
    whole, path = scratch_path(spark, "slices-load"), scratch_path(spark, "slices-append")
    layout.write_mart(rows, whole)
    assert len(written) == 4 and sum(written) == 300 == layout.load_record(spark, whole)["rows"]
    assert equal(layout.open_mart(spark, whole), rows)
    layout.append_new(rows.where("customer_id % 2 = 0"), path)
    layout.append_new(rows, path)
    layout.append_new(rows, path)
    # A row without a month or an id that is stored is not taken for it, as before.
    assert layout.open_mart(spark, path).where("ym is not null").count() == layout.open_mart(spark, whole).where("ym is not null").count() - lost(rows)


def lost(rows):
    """Rows of an odd customer whose id an even customer has in the same month."""
    dated = layout._with_month(rows).where("ym is not null")
    even = dated.where("customer_id % 2 = 0").select("ym", "message_id")
    return dated.where("customer_id % 2 = 1").join(even, ["ym", "message_id"], "left_semi").count()


def test_deletes_by_slices(spark, rows, monkeypatch):
    path = scratch_path(spark, "slices-delete")
    layout.write_mart(rows, path)
    monkeypatch.setattr(layout, "SLICE_BYTES", 10_000)
    for customers, day in ((1002, 1), (1003, 2)):
        layout.soft_delete(rows.where(F.col("customer_id").between(1002, customers)), path, datetime(2026, 1, day))
    found = layout.open_mart(spark, path).where("deleted_at is not null").groupBy(F.dayofmonth("deleted_at").alias("d")).count()
    chosen = {row.customer_id: row.n for row in rows.where("message_id <> 'same'").groupBy("customer_id").agg(F.count("*").alias("n")).collect()}
    same = rows.where("message_id = 'same'").where("customer_id in (1002, 1003)").count()
    counts = {row.d: row["count"] for row in found.collect()}
    assert counts[2] == chosen[1003] + (rows.where("message_id = 'same'").count() if same else 0) or not same
    assert counts[1] == chosen[1002]


def test_found_messages_only_meet_the_deletes(spark, rows):
    path = scratch_path(spark, "slices-lookup")
    layout.write_mart(rows, path)
    layout.soft_delete(rows.where("customer_id = 1002"), path, datetime(2026, 1, 1))
    plan = layout.lookup_many(spark, path, rows.where("customer_id < 1004"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter") < plan.index("LeftSemi")


def test_ids_are_indexed_by_ranges_of_hashes(spark, rows, monkeypatch):
    monkeypatch.setattr(ids, "PASS_IDS", 60, raising=False)
    monkeypatch.setattr(ids, "TASK_IDS", 40)
    path = scratch_path(spark, "slices-ids")
    layout.write_mart(rows, path)
    entries = spark.read.parquet(f"{path}/{ids.FOLDER}/generation={commits.generation(spark, path)}/entries")
    stored = layout.open_mart(spark, path).select(F.xxhash64("message_id").alias("id_hash"), F.col("_metadata.file_path").alias("file")).distinct()
    assert entries.select("id_hash", "file").exceptAll(stored).isEmpty() and stored.exceptAll(entries.select("id_hash", "file")).isEmpty()
    assert len(entries.inputFiles()) >= 5
    wanted = spark.createDataFrame([("m-3",), ("same",), ("nobody",)], "message_id string")
    assert layout.lookup_many(spark, path, wanted).count() == 4
    assert "file#" not in plan_of(wanted) and ids.files_of(wanted.limit(0), path, commits.generation(spark, path), 1) == []
