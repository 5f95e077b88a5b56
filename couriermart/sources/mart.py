"""The message mart, derived from the order tables, and the view without deleted rows.

One line item is one message. Its own columns give the id, time, status, price and
operator; the order gives the customer, receiver and currency; the order's customer
gives the country; the part gives the sender. Every lookup is a left join on the
looked-up table's key, so each line item yields exactly one message whichever columns
are asked for, and a lookup nobody asked for need not be joined at all.

There are no broadcast hints: Spark compares each side's size with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with skewed
partitions split at run time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import MESSAGE_COLUMNS, MESSAGE_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _item_columns() -> dict[str, Column]:
    """Message columns that the line item alone determines."""
    sent = F.col("l_shipdate")
    created = sent + F.expr("interval 1 second")
    quantity = F.col("l_quantity")
    operator = F.col("l_suppkey") % 17
    return {
        "message_id": F.concat_ws("-", *map(_text, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))),
        "sent_date": sent,
        "segment_count": F.col("l_linenumber"),
        "delivery_status": F.when(quantity <= 40, "DELIVRD")
        .when(quantity <= 42, "UNDELIV")
        .when(quantity <= 44, "EXPIRED")
        .when(quantity <= 46, "REJECTD")
        .when(quantity <= 48, "SENT")
        .when(quantity <= 49, "NO ROUTES"),
        "attempt_number": 1 + F.col("l_partkey") % 3,
        "delivery_time": 100 + F.floor("l_extendedprice") % 2901,
        "price": F.least(F.lit(1.0), F.col("l_extendedprice") / 100000),
        "receiver_operator": F.when(operator != 0, F.concat(F.lit("op-"), operator.cast("string"))),
        "direction": F.when(F.col("l_linestatus") == "O", 1).otherwise(0),
        "created_at": created,
        "updated_at": created + F.expr("interval 5 minutes"),
        "deleted_at": F.when(F.col("l_orderkey") % 67 == 0, sent + F.expr("interval 1 day")),
    }


def _order_columns() -> dict[str, Column]:
    """Message columns that need the order."""
    customer = F.col("o_custkey")
    priority = F.col("o_orderpriority")
    return {
        "customer_id": 1001 + customer % 8,
        "application_uuid": F.concat(F.lit("app-"), (customer % 32).cast("string")),
        "receiver": F.when(customer % 97 != 0, F.concat(F.lit("+"), customer.cast("string"))),
        "currency": F.when(priority == "1-URGENT", "EUR")
        .when(priority == "2-HIGH", "USD")
        .when(priority == "4-NOT SPECIFIED", F.lit(None))
        .when(priority.isNotNull(), "RUB"),
    }


def country_name() -> Column:
    """The nation's name as messages carry it: one nation unknown, one undefined."""
    name = F.col("n_name")
    return F.when(name == "NATION_0", F.lit(None)).when(name == "NATION_1", "not_defined").otherwise(name)


def _sender_name() -> Column:
    brand = F.col("p_brand")
    return F.when(brand == "Brand#1", F.lit(None)).when(brand == "Brand#2", "not_defined").otherwise(brand)


def _orders(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """One row per order with the message columns it provides.

    The country is looked up here, before the line items are joined: orders are a
    fraction of the messages, so the widest table is shuffled once and not twice.
    """
    orders = table(spark, sf_dir, "orders")
    provided = {name: column for name, column in _order_columns().items() if name in wanted}
    columns = [column.alias(name) for name, column in provided.items()]
    if "country" in wanted:
        homes = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nations = table(spark, sf_dir, "nation").select("n_nationkey", country_name().alias("country"))
        orders = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"), "left").join(
            nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        columns.append(F.col("country"))
    return orders.select("o_orderkey", *columns)


def _arriving_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a stream of the files that are there and that arrive later."""
    items = table(spark, sf_dir, "lineitem")
    folder = sf_dir.rstrip("/")
    return spark.readStream.schema(items.schema).parquet(f"{folder}/lineitem.parquet*")


def mart(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, stream: bool = False
) -> DataFrame:
    """The message mart, deleted rows included, with the asked-for columns.

    Asking only for what a job reads spares it the lookups it does not need. With
    ``stream``, the line items are a stream, looked up in the other tables as they come.
    """
    wanted = [name for name in MESSAGE_COLUMNS if columns is None or name in set(columns)]
    needs = set(wanted)
    items = _item_columns()
    from_order = needs & {"country", *_order_columns()}
    messages = _arriving_items(spark, sf_dir) if stream else table(spark, sf_dir, "lineitem")
    # The part gives one column and the order up to five, which the part's shuffle would carry if it came second.
    if "sender" in needs:
        parts = table(spark, sf_dir, "part").select("p_partkey", _sender_name().alias("sender"))
        messages = messages.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if from_order:
        messages = messages.join(
            _orders(spark, sf_dir, from_order), F.col("l_orderkey") == F.col("o_orderkey"), "left"
        )
    types = {field.name: field.dataType for field in MESSAGE_SCHEMA}
    return messages.select(
        *[items.get(name, F.col(name)).cast(types[name]).alias(name) for name in wanted]
    )


def active(messages: DataFrame) -> DataFrame:
    """Messages that were not soft-deleted; every analytic job reads these."""
    return messages.where(F.col("deleted_at").isNull())


def active_mart(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """The asked-for columns of the messages that were not soft-deleted."""
    names = list(columns)
    return active(mart(spark, sf_dir, [*names, "deleted_at"])).select(*names)
