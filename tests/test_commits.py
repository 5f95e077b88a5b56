"""Writers that die after any of their writes, and what is left for those who repeat them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from couriermart.contract import MESSAGE_COLUMNS
from couriermart.plans import sqlfunctions
from couriermart.session import scratch_path
from couriermart.sources import commits, ids, layout
from couriermart.streaming import rollup
from messages import messages

DAYS = [datetime(2025, 3, d, 8) for d in (1, 2, 3)]
DELETED = datetime(2025, 4, 1)


class Died(Exception):
    pass


@pytest.fixture
def dies(monkeypatch):
    """``dies(k)``: from now on the k-th write or commit is the last thing that happens. ``dies(None)``: none is."""
    write, commit = DataFrameWriter.parquet, commits.commit
    left = {"n": None}

    def counted(function):
        def call(*args, **kwargs):
            if left["n"] == 0:
                raise Died
            result = function(*args, **kwargs)
            if left["n"] is not None:
                left["n"] -= 1
                if left["n"] == 0:
                    raise Died
            return result

        return call

    monkeypatch.setattr(DataFrameWriter, "parquet", counted(write))
    monkeypatch.setattr(commits, "commit", counted(commit))

    def after(k):
        left["n"] = k

    return after


def load(spark, first, count, **more):
    return messages(
        spark,
        [{"message_id": f"m-{i}", "sent_date": DAYS[i % 3], "price": 0.125 * (1 + i % 5), **more} for i in range(first, first + count)],
    )


def totals(df):
    rows = df.orderBy("day", "country", "delivery_status", "currency").collect()
    return [(r.day, r.country, r.delivery_status, r.currency, r.msgs, r.delivrd, round(r.revenue, 6)) for r in rows]


class Place:
    def __init__(self, spark):
        self.spark, self.root = spark, scratch_path(spark, "commits-test")
        self.mart, self.rollup = f"{self.root}/mart", f"{self.root}/rollup"

    def open(self):
        return layout.open_mart(self.spark, self.mart)

    def follow(self):
        stream = layout.stream_mart(self.spark, self.mart)
        query = rollup.rollup_stream(stream, self.rollup, f"{self.root}/progress", available_now=True)
        try:
            query.awaitTermination()
        finally:
            query.stop()

    def check(self):
        assert totals(rollup.rollup_read(self.spark, self.rollup)) == totals(rollup.rollup_build(self.open()))


def backfill(place):
    rollup.rollup_backfill(place.open(), place.rollup)


def append(place):
    layout.append_new(load(place.spark, 4, 5), place.mart)


def delete(place):
    layout.soft_delete(load(place.spark, 1, 2), place.mart, DELETED)


def reload(place):
    layout.reload(load(place.spark, 20, 4), place.mart, place.rollup)


def rebuild(place):
    rollup.rollup_rebuild(place.open(), place.rollup, [DAYS[0].date(), DAYS[2].date()])


def compact(place):
    rollup.rollup_compact(place.spark, place.rollup)


WRITERS = {
    "backfill": (backfill, False, False), "stream": (Place.follow, False, False), "append": (append, True, False),
    "delete": (delete, True, False), "reload": (reload, True, False), "rebuild": (rebuild, True, False), "compact": (compact, True, True),
}


@pytest.mark.parametrize("name", WRITERS)
def test_every_writer_may_die_after_every_write(spark, dies, name):
    writer, streamed, more = WRITERS[name]
    for k in range(1, 12):
        dies(None)
        place = Place(spark)
        layout.append_new(load(spark, 0, 5), place.mart)
        if streamed:
            place.follow()
        if more:
            layout.append_new(load(spark, 5, 3), place.mart)
            rebuild(place)
            place.follow()
        dies(k)
        try:
            writer(place)
            ended = True
        except Exception as failed:
            assert isinstance(failed, Died) or "Died" in str(failed)
            ended = False
        dies(None)
        if name == "reload":  # mart and rollup are of one generation, whichever it is
            place.check()
        writer(place)
        layout.append_new(load(spark, 30, 2), place.mart)
        place.follow()
        place.check()
        assert ids_found(place) == place.open().count()
        if ended:
            assert k > 1
            return
    raise AssertionError("more writes than expected")


def ids_found(place):
    return layout.lookup_many(place.spark, place.mart, place.open()).count()


def test_a_number_is_given_once(spark):
    root = scratch_path(spark, "numbers")
    assert commits.newest(spark, root) == (-1, {})
    assert commits.commit(spark, root, 0, {"a": 1}) and not commits.commit(spark, root, 0, {"a": 2})
    assert commits.newest(spark, root) == (0, {"a": 1})
    asked = []

    def change(state):
        asked.append(state)
        if len(asked) == 1:
            assert commits.commit(spark, root, 1, {"a": 5})
        return {"a": state["a"] + 1}

    assert commits.update(spark, root, change) == {"a": 6} and len(asked) == 2
    assert commits.update(spark, root, lambda state: None) is None and commits.newest(spark, root) == (2, {"a": 6})
    assert [name for name, _ in commits.children(spark, f"{root}/_commits") if name.endswith(".json")] != []
    assert not [name for name, _ in commits.children(spark, f"{root}/_commits") if name.startswith(".") and not name.endswith(".crc")]


def test_two_streams_and_late_batches_count_once(spark):
    root = scratch_path(spark, "streams")
    for stream in ("a", "b"):
        for batch in (3, 0, 3, 1, 0):
            rollup.rollup_add(load(spark, 0, 2), root, batch, stream)
    assert rollup.rollup_read(spark, root, []).first().msgs == 12
    state = commits.newest(spark, root)[1]
    assert state["batches"] == {"a": [[0, 1], [3, 3]], "b": [[0, 1], [3, 3]]}
    assert rollup.rollup_compact(spark, root) == 3


def test_readers_open_few_runs(spark, monkeypatch):
    monkeypatch.setattr(rollup, "MERGED_RUNS", 3)
    root = scratch_path(spark, "levels")
    for batch in range(30):
        rollup.rollup_add(load(spark, batch, 1), root, batch)
        assert rollup.open_runs(spark, root) <= 2 * 4
    assert rollup.rollup_read(spark, root, []).first().msgs == 30
    before = len(commits.children(spark, f"{root}/runs"))
    kept = rollup.rollup_expire(spark, root, keep_commits=1, older_than_s=3600)
    assert not kept and len(commits.children(spark, f"{root}/runs")) == before
    assert rollup.rollup_expire(spark, root, keep_commits=1, older_than_s=0)
    assert len(commits.children(spark, f"{root}/runs")) == rollup.open_runs(spark, root) < before
    assert rollup.rollup_read(spark, root, []).first().msgs == 30
    rollup.rollup_add(load(spark, 99, 1), root, 30)
    assert rollup.rollup_read(spark, root, []).first().msgs == 31


def test_readers_see_the_old_mart_until_the_new_one_is_whole(spark, dies):
    place = Place(spark)
    layout.write_mart(load(spark, 0, 3), place.mart)
    opened = place.open()
    dies(2)
    with pytest.raises(Died):
        layout.write_mart(load(spark, 10, 7), place.mart)
    dies(None)
    assert place.open().count() == 3
    layout.write_mart(load(spark, 10, 7), place.mart)
    assert place.open().count() == 7 and opened.count() == 3
    gone = layout.expire_mart(spark, place.mart, keep_commits=1, older_than_s=0)
    assert sum(name.startswith("./generation=") for name in gone) == 2 and place.open().count() == 7
    assert layout.lookup(spark, place.mart, "m-12").count() == 1


def test_deletes_before_and_after_their_messages_stream(spark):
    place = Place(spark)
    layout.append_new(load(spark, 0, 6), place.mart)
    place.follow()
    delete(place)
    layout.append_new(load(spark, 6, 6), place.mart)
    layout.soft_delete(load(spark, 5, 4).unionByName(load(spark, 5, 1)), place.mart, DELETED)
    delete(place)
    place.follow()
    place.check()
    assert place.open().where("deleted_at is not null").count() == 6
    assert rollup.rollup_read(spark, place.rollup, []).first().msgs == 6
    layout.soft_delete(place.open(), place.mart, DELETED)
    place.follow()
    assert rollup.rollup_read(spark, place.rollup).isEmpty()
    layout.soft_delete(spark.createDataFrame([], "message_id string"), place.mart, DELETED)
    layout.soft_delete(spark.createDataFrame([(None,), ("none",)], "message_id string"), place.mart, DELETED)
    place.check()


def test_a_backfill_counts_deletes_once(spark):
    place = Place(spark)
    layout.append_new(load(spark, 0, 6), place.mart)
    delete(place)
    backfill(place)
    place.follow()
    place.check()
    layout.soft_delete(load(spark, 4, 1), place.mart, DELETED)
    place.follow()
    place.check()


def _files_opened(df):
    """Files and rows that the scans of ``df`` read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(scan.metrics().apply("numFiles").value() for scan in scans if scan.metrics().contains("numFiles"))


def test_an_id_opens_one_folder_and_one_file(spark):
    place = Place(spark)
    layout.ensure_mart(spark, place.mart, id_buckets=16)
    for first in range(0, 120, 20):
        layout.append_new(load(spark, first, 20), place.mart, partitions=4)
    assert len(place.open().inputFiles()) >= 18
    one = layout.lookup(spark, place.mart, "m-77")
    assert one.count() == 1 and len(one.inputFiles()) == 1 == _files_opened(one)
    generation = commits.generation(spark, place.mart)
    wanted = spark.createDataFrame([("m-77",)], "message_id string")
    entries = ids.entries_of(wanted, place.mart, generation, 16)
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert entries.count() == 1 and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert layout.lookup(spark, place.mart, "nobody").isEmpty()
    many = layout.lookup_many(spark, place.mart, spark.createDataFrame([(f"m-{i}",) for i in (1, 50, 119, 119, 500)], "message_id string"))
    assert sorted(r.message_id for r in many.collect()) == ["m-1", "m-119", "m-50"]
    assert many.columns == [*MESSAGE_COLUMNS, "ym"]


def test_a_folder_of_the_index_is_written_by_many_tasks(spark, monkeypatch):
    place = Place(spark)
    monkeypatch.setattr(ids, "TASK_IDS", 50, raising=False)
    rows = messages(spark, [{"message_id": f"m-{i % 150}", "sent_date": datetime(2025, 1 + i % 3, 1)} for i in range(400)])
    layout.write_mart(rows, place.mart, partitions=4)
    generation = commits.generation(spark, place.mart)
    entries = spark.read.parquet(f"{place.mart}/{ids.FOLDER}/generation={generation}/entries")
    stored = place.open().select(F.xxhash64("message_id").alias("id_hash"), F.col("_metadata.file_path").alias("file")).distinct()
    held = entries.select("id_hash", "file")
    assert held.exceptAll(stored).isEmpty() and stored.exceptAll(held).isEmpty() and entries.select("bucket").distinct().count() == 1
    # Tasks have ranges of hashes, so that a lookup skips most of what they wrote.
    parts = entries.groupBy(F.input_file_name().alias("part")).agg(F.min("id_hash").alias("low"), F.max("id_hash").alias("high"))
    ranges = sorted((row.low, row.high) for row in parts.collect())
    assert len(ranges) >= 6 and all(before[1] < after[0] for before, after in zip(ranges, ranges[1:]))
    wanted = spark.createDataFrame([("m-3",), ("m-149",)], "message_id string")
    assert layout.lookup_many(spark, place.mart, wanted).count() == rows.where("message_id in ('m-3', 'm-149')").count()


def test_an_unfinished_index_is_not_trusted(spark, dies):
    place = Place(spark)
    layout.append_new(load(spark, 0, 4), place.mart)
    dies(2)
    with pytest.raises(Died):
        layout.append_new(load(spark, 4, 4), place.mart)
    dies(None)
    assert not commits.newest(spark, place.mart)[1]["ids_complete"]
    assert layout.lookup(spark, place.mart, "m-6").count() == 1
    assert layout.lookup_many(spark, place.mart, load(spark, 2, 5)).count() == 5
    layout.append_new(load(spark, 4, 4), place.mart)
    assert commits.newest(spark, place.mart)[1]["ids_complete"]
    assert layout.lookup(spark, place.mart, "m-6").count() == 1 and ids_found(place) == 8


def test_functions_for_sql(spark):
    for _ in range(2):
        assert set(sqlfunctions.register_functions(spark)) == set(sqlfunctions.FUNCTIONS)
    row = spark.sql(
        """SELECT status_class('DELIVRD') a, status_class('SENT') b, status_class(NULL) c, delivery_rate(1, 3) d, delivery_rate(1, 0) e,
                  failed_rate(1, 8) f, cost_per_delivered(1.0, 3) g, expected_price(NULL, 3, 0.04) h, expected_price(0.5, 9, 0.04) i"""
    ).first()
    assert tuple(row) == ("delivered", "in_flight", "failed", 33.33, None, 12.5, 0.3333, 0.12, 1.0)
