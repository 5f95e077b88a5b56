"""Checks that come with a load, the report's scans, as-of values and the fingerprint of formats."""

from datetime import date, datetime

from pyspark.sql import functions as F

from couriermart.operators import checks
from couriermart.operators.asof import attach_as_of, validity
from couriermart.operators.profile import dq_metrics, numeric_summary, segment_stats
from couriermart.operators.tariff import convert_revenue
from couriermart.plans.report import NUMERIC_COLUMNS, full_report
from couriermart.contract import NULLABLE_COLUMNS
from couriermart.session import scratch_path
from couriermart.sources import formats, layout
from couriermart.sources.mart import active, mart
from messages import messages


def checked(spark, path):
    report = checks.load_checks(spark, layout.load_record(spark, path), layout.stored_rows(spark, path), layout.stored_schema(spark, path))
    return {r.check: (r.observed, r.passed) for r in report.collect()}


def test_loads_are_checked_on_the_way(spark):
    path = scratch_path(spark, "load-test")
    layout.append_new(messages(spark, [{"price": 0.5}, {"price": 7.0}, {"country": "Nowhere"}, {"country": None}]), path)
    layout.append_new(messages(spark, [{"message_id": "z", "segment_count": 99}, {"message_id": "m-1"}]), path)
    found = checked(spark, path)
    assert found["row_count"] == (5.0, True) and found["columns_matching"] == (18.0, True)
    assert found["price_range"] == (1.0, False) and found["country_domain"] == (1.0, False)
    assert found["segment_count_range"] == (1.0, False) and found["currency_domain"] == (0.0, True)
    layout.write_mart(messages(spark, [{}]), path)
    assert checked(spark, path)["row_count"] == (1.0, True)


def test_a_short_load_fails(spark):
    path = scratch_path(spark, "short-test")
    days = [{"sent_date": datetime(2025, m, 3)} for m in range(1, 7)]
    layout.append_new(messages(spark, days), path)
    lost = layout.open_mart(spark, path).where("ym = 202503").inputFiles()[0]
    where = spark._jvm.org.apache.hadoop.fs.Path(lost)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, False)
    assert checked(spark, path)["row_count"] == (5.0, False)
    empty = scratch_path(spark, "empty-test")
    layout.ensure_mart(spark, empty)
    assert not checked(spark, empty)["row_count"][1]


def test_files_of_another_schema_fail(spark):
    path = scratch_path(spark, "schema-test")
    layout.append_new(messages(spark, [{}, {}]), path)
    folder = layout.open_mart(spark, path).inputFiles()[0].rsplit("/", 2)[0]
    other = messages(spark, [{"message_id": "other"}]).withColumn("price", F.col("price").cast("string"))
    other.write.parquet(f"{folder}/ym=202502")
    found = checked(spark, path)
    assert found["columns_matching"] == (0.0, False)


def _rows_read(spark):
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def test_the_report_reads_the_messages_three_times(spark, sf_dir):
    path = scratch_path(spark, "report-scans")
    mart(spark, sf_dir).write.parquet(path)
    rows = spark.read.parquet(path)
    total, before = rows.count(), _rows_read(spark)
    frames = {name: frame.collect() for name, frame in full_report(rows).items()}
    assert _rows_read(spark) - before <= 3 * total + 200

    def near(got, expected):
        assert len(got) == len(expected)
        for a, b in zip(got, expected, strict=True):
            for x, y in zip(a, b.asDict().values(), strict=True):
                assert x == y or abs(x - y) <= 1e-9 * max(1, abs(y))

    kept = active(rows)
    summary = sorted(frames["summary"], key=lambda r: r.column)
    near([[r[name] for name in numeric_summary(kept, ["price"]).columns] for r in summary],
         sorted(numeric_summary(kept, NUMERIC_COLUMNS).collect(), key=lambda r: r.column))
    near(frames["price_by_country"], segment_stats(kept, "country").collect())
    near(frames["price_by_customer"], segment_stats(kept, "customer_id").collect())
    key = lambda r: r.column
    near(sorted(frames["dq"], key=key), sorted(dq_metrics(rows, NULLABLE_COLUMNS).collect(), key=key))


def test_the_report_of_nothing(spark):
    for rows in ([], [{"price": None, "delivery_time": None}], [{"price": float("nan"), "country": None}, {"deleted_at": datetime(2025, 1, 1)}]):
        frames = {name: frame.collect() for name, frame in full_report(messages(spark, rows)).items()}
        assert len(frames["dq"]) == len(NULLABLE_COLUMNS) and len(frames["summary"]) == (2 if rows else 0)


RATES = [("EUR", date(2025, 1, 10), 2.0), ("EUR", date(2025, 1, 10), 3.0), ("EUR", date(2025, 3, 5), 5.0), ("EUR", date(2025, 3, 6), None),
         ("USD", None, 9.0), ("USD", date(2025, 2, 1), 1.0), (None, date(2024, 1, 1), 8.0), ("RUB", date(2025, 12, 1), 4.0)]


def test_the_last_known_value_holds(spark):
    rates = spark.createDataFrame(RATES, "currency string, day date, rate double")
    intervals = validity(rates, ["currency"], "day", "rate")
    days = [("EUR", date(2025, 1, 9)), ("EUR", date(2025, 1, 10)), ("EUR", date(2025, 2, 28)), ("EUR", date(2025, 3, 4)), ("EUR", date(2025, 3, 5)),
            ("EUR", date(2026, 7, 1)), ("USD", date(2025, 1, 31)), ("USD", date(2025, 2, 1)), (None, date(2025, 2, 1)), ("EUR", None),
            ("GBP", date(2025, 2, 1)), ("RUB", date(2025, 5, 5)), ("EUR", date(2025, 3, 5))]
    rows = spark.createDataFrame(days, "currency string, sent date")
    got = attach_as_of(rows, intervals, ["currency"], "sent", "rate").collect()
    assert len(got) == len(days)
    found = {(r.currency, r.sent): r.rate for r in got}
    assert found == dict(zip(days, [None, 3.0, 3.0, 3.0, 5.0, 5.0, None, 1.0, None, None, None, None, 5.0], strict=True))
    assert attach_as_of(rows, intervals.limit(0), ["currency"], "sent", "rate").where("rate is not null").isEmpty()
    assert attach_as_of(rows.limit(0), intervals, ["currency"], "sent", "rate").isEmpty()


def test_conversion_with_gaps(spark):
    rates = spark.createDataFrame(RATES, "currency string, day date, rate double")
    sent = messages(spark, [{"currency": "EUR", "sent_date": datetime(2025, 2, 3, 9), "price": 0.5}, {"currency": "EUR", "sent_date": datetime(2025, 1, 1)},
                            {"currency": None}, {"currency": "USD", "sent_date": datetime(2025, 2, 9), "price": 0.25}])
    got = {r.currency: (r.sms, r.revenue_converted, r.sms_without_rate) for r in convert_revenue(sent, rates, as_of=True).collect()}
    assert got == {"EUR": (2, 1.5, 1), "USD": (1, 0.25, 0), None: (1, None, 1)}


def test_the_fingerprint_sees_moved_and_swapped_rows(spark):
    rows = messages(spark, [{"message_id": "a", "sender": "x", "receiver": None}, {"message_id": "b"}, {"message_id": "c"}])
    moved = messages(spark, [{"message_id": "a", "sender": None, "receiver": "x"}, {"message_id": "b"}, {"message_id": "c"}])
    doubled = messages(spark, [{"message_id": "a", "sender": "x", "receiver": None}, {"message_id": "b"}, {"message_id": "b"}])
    for name, other in (("same", rows), ("moved", moved), ("doubled", doubled)):
        (result,) = formats.compare_formats(other, scratch_path(spark, f"print-{name}"), ["parquet"])
        assert formats.survivors(rows, [result]).first().same_rows == (name == "same")
