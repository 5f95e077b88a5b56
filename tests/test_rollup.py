from datetime import date, datetime

import pytest

from couriermart.contract import MESSAGE_SCHEMA
from couriermart.session import scratch_path
from couriermart.sources import layout
from couriermart.streaming import rollup
from messages import messages

DAY1, DAY2, OLD = datetime(2025, 3, 1, 8), datetime(2025, 3, 2, 9), datetime(2020, 1, 1)


@pytest.fixture
def root(spark):
    return scratch_path(spark, "rollup-test")


def _totals(df):
    rows = rollup.rollup_merge(df, ["day"]).orderBy("day").collect()
    return [(r.day, r.msgs, r.delivrd, round(r.revenue, 6)) for r in rows]


def _fact(spark, *extra):
    return messages(
        spark,
        [
            {"sent_date": DAY1, "price": 0.1},
            {"sent_date": DAY1, "price": 0.2, "delivery_status": None},
            {"sent_date": DAY2, "price": 0.3, "country": None},
            {"sent_date": DAY2, "price": 0.9, "deleted_at": DAY2},
            *extra,
        ],
    )


def test_null_status_is_not_delivered_and_deleted_rows_are_out(spark):
    assert _totals(rollup.rollup_build(_fact(spark))) == [
        (date(2025, 3, 1), 2, 1, 0.3),
        (date(2025, 3, 2), 1, 1, 0.3),
    ]


def test_replayed_batch_counts_once(spark, root):
    for _ in range(3):
        rollup.rollup_add(_fact(spark), root, 0)
    assert _totals(rollup.rollup_read(spark, root)) == _totals(rollup.rollup_build(_fact(spark)))


def test_late_rows_add_to_their_day(spark, root):
    rollup.rollup_add(_fact(spark), root, 0)
    rollup.rollup_add(messages(spark, [{"sent_date": OLD}]), root, 1)
    assert _totals(rollup.rollup_read(spark, root))[0] == (date(2020, 1, 1), 1, 1, 0.5)


def test_backfill_only_fills_an_empty_rollup(spark, root):
    assert not rollup.rollup_backfill(messages(spark, [{"deleted_at": DAY1}]), root)
    assert rollup.rollup_backfill(_fact(spark), root)
    assert not rollup.rollup_backfill(_fact(spark), root)
    assert sum(row[1] for row in _totals(rollup.rollup_read(spark, root))) == 3


def test_stream_equals_batch(spark, root):
    """Several micro-batches, restarted, continue where they stopped."""
    source, fact = f"{root}/source", _fact(spark)
    fact.repartition(4).write.parquet(source)

    def run():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        query = rollup.rollup_stream(stream, f"{root}/rollup", f"{root}/progress", available_now=True)
        query.awaitTermination()

    run()
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == _totals(rollup.rollup_build(fact))
    more = messages(spark, [{"sent_date": OLD}, {"sent_date": DAY1}])
    more.write.mode("append").parquet(source)
    run()
    both = fact.unionByName(more)
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == _totals(rollup.rollup_build(both))


def test_backfill_then_stream(spark, root):
    fact = _fact(spark)
    assert rollup.rollup_backfill(fact, f"{root}/rollup")
    later = messages(spark, [{"sent_date": DAY2, "price": 0.7}])
    later.write.parquet(f"{root}/later")
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(f"{root}/later")
    rollup.rollup_stream(stream, f"{root}/rollup", f"{root}/progress", available_now=True).awaitTermination()
    expected = _totals(rollup.rollup_build(fact.unionByName(later)))
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == expected


def test_rebuild_takes_out_later_deletes(spark, root):
    rollup.rollup_add(_fact(spark), root, 0)
    fixed = messages(
        spark,
        [
            {"sent_date": DAY1, "price": 0.1},
            {"sent_date": DAY1, "price": 0.2, "deleted_at": DAY2},
            {"sent_date": DAY2, "price": 0.3, "deleted_at": DAY2},
        ],
    )
    for _ in range(2):
        rollup.rollup_rebuild(fixed, root, [DAY1.date(), DAY2.date()])
        assert _totals(rollup.rollup_read(spark, root)) == [(date(2025, 3, 1), 1, 1, 0.1)]
    rollup.rollup_add(messages(spark, [{"sent_date": DAY2}]), root, 1)
    assert _totals(rollup.rollup_read(spark, root)) == [
        (date(2025, 3, 1), 1, 1, 0.1),
        (date(2025, 3, 2), 1, 1, 0.5),
    ]


def test_compaction_changes_nothing_and_goes_on(spark, root):
    rollup.rollup_add(_fact(spark), root, 0)
    rollup.rollup_add(messages(spark, [{"sent_date": OLD}]), root, 1)
    before = _totals(rollup.rollup_read(spark, root))
    assert rollup.rollup_compact(spark, root) == 1
    assert rollup.rollup_compact(spark, root) == 1
    assert _totals(rollup.rollup_read(spark, root)) == before
    rollup.rollup_add(messages(spark, [{"sent_date": OLD}]), root, 2)
    assert _totals(rollup.rollup_read(spark, root))[0] == (date(2020, 1, 1), 2, 2, 1.0)
    rollup.rollup_compact(spark, root)
    assert _totals(rollup.rollup_read(spark, root))[0] == (date(2020, 1, 1), 2, 2, 1.0)


def _stream(spark, mart, root):
    source = layout.stream_mart(spark, mart)
    rollup.rollup_stream(source, f"{root}/rollup", f"{root}/progress", available_now=True).awaitTermination()


def test_backfill_then_stream_of_the_same_mart(spark, root):
    mart = f"{root}/mart"
    layout.write_mart(_fact(spark), mart)
    assert rollup.rollup_backfill(layout.open_mart(spark, mart), f"{root}/rollup")
    _stream(spark, mart, root)
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == _totals(rollup.rollup_build(_fact(spark)))
    layout.append_new(messages(spark, [{"message_id": "new", "sent_date": DAY2, "price": 0.7}]), mart)
    _stream(spark, mart, root)
    fresh = rollup.rollup_build(layout.open_mart(spark, mart))
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == _totals(fresh)


def test_reload_under_a_stream(spark, root):
    mart = f"{root}/mart"
    layout.write_mart(_fact(spark), mart)
    _stream(spark, mart, root)
    layout.reload(_fact(spark, {"sent_date": OLD}), mart, f"{root}/rollup")
    _stream(spark, mart, root)
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == _totals(rollup.rollup_build(layout.open_mart(spark, mart)))


def test_rebuild_with_rows_yet_to_stream(spark, root):
    mart = f"{root}/mart"
    layout.write_mart(_fact(spark), mart)
    _stream(spark, mart, root)
    more = [{"message_id": "a", "sent_date": DAY1, "price": 0.4}, {"message_id": "b", "sent_date": OLD, "price": 0.6}]
    layout.append_new(messages(spark, more), mart)
    rollup.rollup_rebuild(layout.open_mart(spark, mart), f"{root}/rollup", [DAY1.date()])
    _stream(spark, mart, root)
    assert _totals(rollup.rollup_read(spark, f"{root}/rollup")) == _totals(rollup.rollup_build(layout.open_mart(spark, mart)))
