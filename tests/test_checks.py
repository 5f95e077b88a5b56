import json
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from couriermart import contract
from couriermart.functions.scalars import clip, named_uuid
from couriermart.operators import checks, tariff
from couriermart.session import scratch_path
from messages import messages


def _passed(df):
    return {r["check"]: r.passed for r in df.collect()}


def _observed(df):
    return {r["check"]: r.observed for r in df.collect()}


def test_smoke_passes_and_fails(spark):
    rows = [{"customer_id": 1 + i % 2, "sent_date": datetime(2025, 1 + i % 12, 28)} for i in range(100)]
    df = messages(spark, rows)
    assert all(_passed(checks.smoke_checks(df, 101)).values())
    failed = _passed(checks.smoke_checks(messages(spark, [{"country": None, "deleted_at": datetime(2025, 1, 1)}]), 100))
    assert not any(failed[name] for name in ("row_count", "period_days", "customers", "country_known"))
    assert not failed["delivery_rate_pct"] and not failed["revenue_active"]


def test_ranges_count_violations(spark):
    rows = [{}, {"price": 1.5}, {"segment_count": 15}, {"attempt_number": 0}, {"delivery_time": 99}]
    df = messages(spark, rows)
    sent_range = (datetime(2025, 1, 1), datetime(2025, 1, 15, 12))
    got = _observed(checks.range_checks(df, sent_range=sent_range))
    assert got["price_range"] == got["segment_count_range"] == got["attempt_number_range"] == 1
    assert got["delivery_time_range"] == 1
    assert got["sent_date_range"] == 5  # the end is not included


def test_domains_allow_null(spark):
    df = messages(spark, [{"currency": c} for c in ("RUB", None, "GBP")])
    got = _observed(checks.domain_checks(df))
    assert got["currency_domain"] == 1 and got["country_domain"] == 0


def test_pairing(spark):
    df = messages(spark, [{"application_uuid": a, "customer_id": c} for a, c in (("x", 1), ("x", 1), ("y", 1), ("y", 2))])
    assert _observed(checks.pairing_checks(df)) == {"applications": 2.0, "shared_applications": 1.0}


def test_shares(spark):
    rows = [{"delivery_status": "DELIVRD" if i < 80 else "SENT", "currency": "RUB" if i % 2 else "USD"} for i in range(100)]
    got = _passed(checks.share_checks(messages(spark, rows)))
    assert got["delivered_share"] and not got["deleted_share"]
    assert not got["currency_nulls"] and not got["RUB_lead"]


def test_real_rate_card(spark):
    card = tariff.rate_card(spark)
    rows = [
        {"receiver": "+7900"},
        {"receiver": "+1900"},
        {"country": "Israel", "receiver": "+972500", "receiver_operator": "All networks", "segment_count": 14},
        {"country": "Israel", "receiver": "+972500", "receiver_operator": "MTS"},
        {"country": None, "receiver_operator": None},
        {"country": "Atlantis"},
    ]
    df = messages(spark, rows)
    (row,) = tariff.card_violations(df, card).collect()
    assert (row.rows, row.wrong_operator, row.wrong_prefix) == (6, 1, 1)
    prices = {r.message_id: r.expected_price for r in tariff.tariff(df, card).collect()}
    assert prices == {"m-0": 0.03, "m-1": 0.03, "m-2": 1.0, "m-3": 0.075, "m-4": 0.04, "m-5": 0.04}
    assert card.count() == len(contract.COUNTRIES)
    got = _observed(checks.reconcile_checks(df, card, ["country", "customer_id"]))
    assert got["country_difference"] == got["customer_id_difference"] == 0
    assert got["columns_matching"] == 18 and got["wrong_prefix"] == 1


def test_reconcile_notices_missing_prices(spark):
    got = _passed(checks.reconcile_checks(messages(spark, [{}, {"price": None}]), tariff.rate_card(spark), ["country"]))
    assert not got["country_difference"]


def test_rollup_differences(spark):
    schema = "day date, country string, delivery_status string, currency string, msgs long, delivrd long, revenue double"
    day = datetime(2025, 1, 1).date()
    left = spark.createDataFrame([(day, None, "A", "X", 1, 1, 0.1), (day, "c", "A", "X", 2, 1, 0.1)], schema)
    right = spark.createDataFrame([(day, None, "A", "X", 1, 1, 0.1 + 1e-15), (day, "d", "A", "X", 2, 1, 0.1)], schema)
    (row,) = checks.rollup_differences(left, right, contract.ROLLUP_KEYS).collect()
    assert (row.buckets, row.differences) == (3, 2)


def test_status_class(spark):
    df = messages(spark, [{"delivery_status": s, "delivery_time": t} for s, t in
                          (("DELIVRD", 100), ("SENT", 300), ("UNKNOWN", 500), ("EXPIRED", 900), (None, 1000))])
    got = {r.status_class: (r["count"], r["median"]) for r in tariff.delivery_time_by_status_class(df).collect()}
    assert got == {"delivered": (1, 100.0), "in_flight": (2, 400.0), "failed": (2, 950.0)}


def test_conversion(spark):
    rates = spark.createDataFrame([("USD", datetime(2025, 1, 15).date(), 2.0)], "currency string, day date, rate double")
    df = messages(spark, [{"currency": "USD"}, {"currency": "USD", "sent_date": datetime(2025, 1, 16)}])
    (row,) = tariff.convert_revenue(df, rates).collect()
    assert (row.sms, row.revenue, row.revenue_converted, row.sms_without_rate) == (2, 1.0, 1.0, 1)


def test_named_uuid_is_the_standard_one(spark):
    names = ["app-1001-0", "", "ü", *[f"n{i}" for i in range(50)]]
    rows = spark.createDataFrame([(n,) for n in names], "name string").select("name", named_uuid("name").alias("id"))
    assert {r.name: r.id for r in rows.collect()} == {n: str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names}


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (9.0,), (None,)], "x double").select(clip(F.col("x"), 0.0, 1.0))
    assert [r[0] for r in df.collect()] == [0.0, 0.5, 1.0, None]


def test_field_specs_from_file(spark):
    folder = scratch_path(spark, "spec-test")
    body = {"fields": {"currency": {"values": ["GBP"]}, "price": {"min": 0.0, "max": 2.0},
                       "sender": {"values": []}, "sent_date": {"min": "2025-01-01", "max": "2026-01-01"}}}
    spark.createDataFrame([(json.dumps(body),)], "value string").coalesce(1).write.text(folder)
    specs = {s.name: s for s in contract.load_field_specs(spark, folder)}
    assert specs["currency"].values == ("GBP",) and specs["price"].high == 2.0
    assert specs["sender"].values == tuple(contract.SENDERS)
    assert "sent_date" not in specs
    assert [s.name for s in contract.load_field_specs(spark)] == [s.name for s in contract.FIELD_SPECS]


def test_contract_is_order_and_type_sensitive(spark):
    df = messages(spark, [{}])
    assert contract.same_contract(df.schema)
    assert not contract.same_contract(df.select(*reversed(df.columns)).schema)
    assert not contract.same_contract(df.withColumn("price", F.col("price").cast("float")).schema)
