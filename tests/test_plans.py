"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from couriermart.plans.queries import QUERIES
from couriermart.sources.mart import active_mart, mart
from support import TESTDATA, plan_of

SF = f"{TESTDATA}/sf0.01"
LAZY = [
    "sms_by_day", "kpi_summary", "top_countries", "filtered_chart", "rollup_daily", "revenue_running_total",
    "revenue_mom", "top3_countries_by_month", "rank_countries", "cohort_retention", "cohort_heatmap",
    "receiver_lifecycle", "dq_metrics", "expected_tariff", "checks_smoke", "checks_pairing", "message_key_hash",
    "describe_price", "segment_by_country", "customer_tiers",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan


@pytest.mark.parametrize(
    "columns, tables",
    [
        (["price", "delivery_status", "message_id"], {"lineitem"}),
        (["customer_id", "currency"], {"lineitem", "orders"}),
        (["country"], {"lineitem", "orders", "customer", "nation"}),
        (["sender"], {"lineitem", "part"}),
    ],
)
def test_only_needed_tables_are_read(spark, columns, tables):
    read = {path.rsplit("/", 1)[1] for path in mart(spark, SF, columns).inputFiles()}
    assert read == {f"{name}.parquet" for name in tables}


def test_columns_are_pruned(spark):
    plan = plan_of(active_mart(spark, SF, ["price"]).agg(F.sum("price")))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_extendedprice", "l_shipdate"}


def test_each_message_comes_once_whatever_is_asked_for(spark):
    items = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    for columns in (["price"], ["country"], ["sender", "currency"], None):
        assert mart(spark, SF, columns).count() == items


@pytest.mark.parametrize("table, key", [("orders", "o_orderkey"), ("customer", "c_custkey"),
                                        ("nation", "n_nationkey"), ("part", "p_partkey")])
def test_looked_up_keys_are_unique(spark, table, key):
    df = spark.read.parquet(f"{SF}/{table}.parquet")
    assert df.select(key).distinct().count() == df.count()


def test_top_n_limits_before_the_shuffle(spark):
    plan = plan_of(QUERIES["top3_countries_by_month"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_countries"](spark, SF))


def test_cohorts_join_nothing_to_the_messages_again(spark):
    for name in ("cohort_retention", "receiver_lifecycle"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert plan.count("FileScan") == 2  # line items and orders, once each
