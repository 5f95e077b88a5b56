from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from couriermart.contract import MESSAGE_COLUMNS
from couriermart.plans.datasets import ensure_datasets
from couriermart.plans.report import full_report
from couriermart.session import scratch_path
from couriermart.sources import formats, layout, reports
from couriermart.sources.mart import mart
from couriermart.streaming.rollup import rollup_read, rollup_stream
from messages import messages
from support import plan_of


@pytest.fixture(scope="module")
def path(spark, sf_dir):
    where = scratch_path(spark, "layout-test")
    layout.write_mart(mart(spark, sf_dir), where)
    return where


def test_rows_survive(spark, sf_dir, path):
    stored, derived = layout.open_mart(spark, path).select(*MESSAGE_COLUMNS), mart(spark, sf_dir)
    assert stored.exceptAll(derived).isEmpty() and derived.exceptAll(stored).isEmpty()


def test_period_prunes_months_and_pushes_the_rest(spark, path):
    df = layout.customer_period(spark, path, 1002, datetime(1996, 2, 3), datetime(1996, 3, 4))
    plan = plan_of(df)
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "199602" in partition_filters and "199603" in partition_filters
    assert "EqualTo(customer_id,1002)" in pushed and "sent_date" in pushed
    assert {r.customer_id for r in df.collect()} == {1002}


def test_lookup_is_pushed_down_and_may_find_several(spark, path):
    counts = layout.open_mart(spark, path).groupBy("message_id").count()
    twice = counts.where("count = 2").first()
    found = layout.lookup(spark, path, twice.message_id)
    assert found.count() == 2
    assert "EqualTo(message_id," in plan_of(found)
    assert layout.lookup(spark, path, "no such id").isEmpty()


def test_files_are_sorted(spark, path):
    rows = (
        layout.open_mart(spark, path)
        .where("ym = 199605")
        .select("customer_id", "sent_date", F.input_file_name().alias("file"))
        .collect()
    )
    for name in {r.file for r in rows}:
        inside = [(r.customer_id, r.sent_date) for r in rows if r.file == name]
        assert inside == sorted(inside)


def _rows_scanned(df):
    """Rows that the file scan of ``df`` hands on, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_lookup_skips_row_groups(spark, path):
    """Every file's smallest and largest id are far apart: only bloom filters can skip."""
    stored = layout.open_mart(spark, path)
    some = stored.where("ym = 199605").first().message_id
    assert _rows_scanned(stored.where("segment_count < 99")) == 6000
    assert _rows_scanned(layout.lookup(spark, path, some)) < 600
    assert _rows_scanned(layout.lookup(spark, path, "3-3-333333-3")) < 600


def test_append_adds_only_new_ids(spark):
    where = scratch_path(spark, "append-test")
    first = messages(spark, [{"message_id": "a"}, {"message_id": "b"}])
    layout.append_new(first, where)
    layout.append_new(first, where)
    assert layout.open_mart(spark, where).count() == 2
    more = messages(spark, [{"message_id": "b"}, {"message_id": "c", "sent_date": datetime(2025, 7, 1)}])
    layout.append_new(more, where)
    ids = {r.message_id for r in layout.open_mart(spark, where).select("message_id").collect()}
    assert ids == {"a", "b", "c"} and layout.open_mart(spark, where).count() == 3


def test_whole_messages_meet_stored_ids_only_in_months_stored_in_part(spark):
    where = scratch_path(spark, "unseen-test")
    day = {month: datetime(2025, month, 3) for month in (1, 2, 3)}
    rows = [{"message_id": f"{month}-{i % 3}", "sent_date": day[month]} for month in day for i in range(4)]
    layout.append_new(messages(spark, rows[:4] + rows[4:5]), where)
    again = layout.unseen(messages(spark, rows[:4] + rows[8:]), where)
    assert "Join" not in plan_of(again) and again.count() == 4
    assert layout.unseen(messages(spark, rows[:4]), where).isEmpty()
    late = messages(spark, rows).select(*[F.when(F.col("message_id") != "3-1", F.col(c)).alias(c) if c in ("message_id", "sent_date") else c for c in MESSAGE_COLUMNS])
    part = layout.unseen(late, where)
    assert part.columns == layout.STORED_SCHEMA.names and plan_of(part).count("Join") >= 1
    found = sorted((str(r.ym), str(r.message_id)) for r in part.collect())
    assert found == [("202502", "2-1"), ("202502", "2-2"), *[("202503", "3-0")] * 2, ("202503", "3-2"), ("None", "None")]
    # The same row without month or id is never taken for a stored one.
    layout.append_new(late, where)
    assert [(r.ym, r.message_id) for r in layout.unseen(late, where).collect()] == [(None, None)]
    layout.append_new(messages(spark, []), where)
    assert layout.open_mart(spark, where).count() == 11


def test_ensure_creates_once(spark):
    where = scratch_path(spark, "ensure-test")
    assert layout.ensure_mart(spark, where).isEmpty()
    layout.append_new(messages(spark, [{}]), where)
    assert layout.ensure_mart(spark, where).count() == 1


def test_reload_replaces_the_rollup_too(spark):
    root = scratch_path(spark, "reload-test")
    for count in (3, 2):
        layout.reload(messages(spark, [{}] * count), f"{root}/mart", f"{root}/rollup")
        assert layout.open_mart(spark, f"{root}/mart").count() == count
        assert rollup_read(spark, f"{root}/rollup").agg(F.sum("msgs")).first()[0] == count


def test_views_answer_sql(spark, path):
    rollup_root = scratch_path(spark, "views-rollup")
    for _ in range(2):
        assert all(ensure_datasets(spark, path, rollup_root).values())
    base, kept, rolled = (
        spark.sql(f"SELECT {what}").first()[0]
        for what in (
            "count(*) FROM messages_mart", "count(*) FROM messages_mart_active", "sum(msgs) FROM messages_daily",
        )
    )
    assert base == 6000 and 0 < kept < base and rolled == kept
    assert spark.sql("SELECT min(retention_pct) FROM cohort_retention WHERE month_index = 0").first()[0] == 100.0


def test_setup_of_nothing(spark):
    root = scratch_path(spark, "setup-test")
    assert all(ensure_datasets(spark, f"{root}/mart", f"{root}/rollup").values())
    assert spark.table("messages_mart").isEmpty() and spark.table("messages_daily").isEmpty()


def test_every_append_reaches_the_rollup(spark):
    root = scratch_path(spark, "append-rollup")
    where, rollup_root = f"{root}/mart", f"{root}/rollup"
    layout.ensure_mart(spark, where)
    loads = [[{"message_id": "a"}, {"message_id": "b", "deleted_at": datetime(2025, 2, 2)}],
             [{"message_id": "a"}, {"message_id": "c", "sent_date": datetime(2024, 1, 1)}]]
    for load in loads:
        layout.append_new(messages(spark, load), where)
        stream = layout.stream_mart(spark, where, files_per_batch=1)
        rollup_stream(stream, rollup_root, f"{root}/progress", available_now=True).awaitTermination()
    got = rollup_read(spark, rollup_root).agg(F.sum("msgs"), F.count("*")).first()
    assert tuple(got) == (2, 2)


def test_formats_agree(spark, path):
    rows = layout.open_mart(spark, path).select(*MESSAGE_COLUMNS)
    results = formats.compare_formats(rows, scratch_path(spark, "formats-test"))
    assert all(r.size_bytes > 0 and r.write_s > 0 and r.read_s > 0 for r in results)
    prints = {tuple(r)[1:] for r in formats.survivors(rows, results).collect()}
    assert len(prints) == 1
    assert formats.against_csv(results)["parquet"]["smaller"] > 1


def test_formats_keep_every_value(spark):
    odd = [
        {"sent_date": datetime(2025, 1, 1, 2, 3, 4, 567891), "sender": "", "receiver": None},
        {"sender": 'a "quoted", value', "receiver_operator": "line\nbreak", "price": 0.1 + 0.2},
        {"sender": "  blanks ", "receiver_operator": "back\\slash", "country": "\\"},
    ]
    rows = messages(spark, odd)
    for result in formats.compare_formats(rows, scratch_path(spark, "values-test")):
        options = {"multiLine": "true"} if result.format == "csv" else {}
        back = formats.read_back(rows, result, **options)
        assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty(), result.format


def test_report_is_dated_and_replaced(spark, path):
    root = scratch_path(spark, "report-test")
    frames = full_report(layout.open_mart(spark, path))
    for _ in range(2):
        reports.save_report(frames, root, date(2025, 5, 1))
    assert set(frames) == {"summary", "price_by_country", "price_by_customer", "dq"}
    saved = reports.read_report(spark, root, "summary")
    assert saved.count() == 2 and {str(r.report_date) for r in saved.collect()} == {"2025-05-01"}
