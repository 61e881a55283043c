"""Inputs that the registered queries derive from the test tables, row by row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronofold.operators.scd2 import Dimension
from chronofold.sources.tables import load

AS_OF = dt.date(2024, 6, 1)
CUSTOMER_DIM = Dimension(keys=("id",), tracked=("city",))
ORDER_DIM = Dimension(keys=("order_id",), tracked=("status", "priority"))

SHIPMENT_SCHEMA = (
    "order_id BIGINT, ship STRUCT<flag: STRING, status: STRING>, "
    "items ARRAY<STRUCT<product: BIGINT, qty: DOUBLE, price: DOUBLE>>"
)
SHIPMENT_PARENTS = {"order_id": "order_id", "ship_flag": "ship.flag", "ship_status": "ship.status"}
SHIPMENT_ITEMS = {"product": "product", "qty": "qty", "price": "price"}


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """A nested message per line item: sold, and for returned goods also taken back.

    Accepted lines have an empty list of items when they are final and none at all when not.
    """

    def item(sign: int):
        return F.struct(
            F.col("l_partkey").alias("product"),
            (F.col("l_quantity") * sign).alias("qty"),
            (F.col("l_extendedprice") * sign).alias("price"),
        )

    sold, returned = item(1), item(-1)
    flag = F.col("l_returnflag")
    empty = F.slice(F.array(sold), 1, 0)
    items = (
        F.when(flag == "R", F.array(sold, returned))
        .when(flag == "N", F.array(sold))
        .when(F.col("l_linestatus") == "F", empty)
    )
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.struct(flag.alias("flag"), F.col("l_linestatus").alias("status")).alias("ship"),
        items.alias("items"),
    )


def shipment_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The shipments as JSON text."""
    return shipments(spark, folder).select(
        F.to_json(F.struct("order_id", "ship", "items")).alias("raw_json")
    )


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as records of their lines that are not empty; null where text has one line."""
    lines = F.filter(F.split("text", "\n", -1), lambda line: line != "")
    records = F.transform(
        lines, lambda line: F.struct(line.alias("body"), F.length(line).alias("n"))
    )
    return load(spark, folder, "documents").select(
        "doc_id",
        F.struct("lang", "source").alias("meta"),
        F.when(F.contains(F.col("text"), F.lit("\n")), records).alias("lines"),
    )


def located_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a struct of their nation that holds a struct of its region."""
    nation = load(spark, folder, "nation")
    region = load(spark, folder, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        F.struct(
            F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")
        ).alias("nation"),
    )
    customer = load(spark, folder, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        "c_custkey", "c_name", "nation"
    )


def customer_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as one version, closed for those with a negative balance."""
    open_account = F.col("c_acctbal") >= 0
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.lit(dt.date(2023, 1, 1)).alias("eff_start"),
        F.when(open_account, F.lit(dt.date(9999, 12, 31)))
        .otherwise(F.lit(dt.date(2023, 8, 19)))
        .alias("eff_end"),
        open_account.alias("is_current"),
    )


def customer_feed(spark: SparkSession, folder: str, moved: str = "MOVED") -> DataFrame:
    """A feed of four of the five segments, some rows moved, and all suppliers as new ids."""
    customers = (
        load(spark, folder, "customer")
        .where("c_mktsegment <> 'BUILDING'")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_nationkey") < 10, F.lit(moved))
            .otherwise(F.col("c_mktsegment"))
            .alias("city"),
        )
    )
    suppliers = load(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("id"),
        F.col("s_name").alias("name"),
        F.lit("SUPPLIER").alias("city"),
    )
    return customers.unionByName(suppliers)


def order_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as one version from its order date on; finished ones are closed."""
    done = F.col("o_orderstatus") == "F"
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("eff_start"),
        F.when(done, F.date_add(F.col("o_orderdate").cast("date"), 90))
        .otherwise(F.lit(dt.date(9999, 12, 31)))
        .alias("eff_end"),
        (~done).alias("is_current"),
    )


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """All orders since 1997: open ones are now finished, low priorities are raised."""
    return (
        load(spark, folder, "orders")
        .where("o_orderdate >= timestamp_ntz '1997-01-01 00:00:00'")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "O", F.lit("F"))
            .otherwise(F.col("o_orderstatus"))
            .alias("status"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("4-NOT SPECIFIED"))
            .otherwise(F.col("o_orderpriority"))
            .alias("priority"),
        )
    )


def supplier_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A long history: every line item is a closed version of its supplier.

    About four fifths of all rows are versions of supplier 0. Every supplier is current.
    """
    shipped = F.col("l_shipdate").cast("date")
    larger = F.col("l_quantity") > 10
    closed = load(spark, folder, "lineitem").select(
        F.when(larger, F.lit(0).cast("bigint")).otherwise(F.col("l_suppkey")).alias("id"),
        F.col("l_linestatus").alias("name"),
        F.col("l_returnflag").alias("city"),
        shipped.alias("eff_start"),
        shipped.alias("eff_end"),
        F.lit(False).alias("is_current"),
    )
    current = load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("city"),
        F.lit(dt.date(2023, 1, 1)).alias("eff_start"),
        F.lit(dt.date(9999, 12, 31)).alias("eff_end"),
        F.lit(True).alias("is_current"),
    )
    return closed.unionByName(current)


def supplier_feed(spark: SparkSession, folder: str) -> DataFrame:
    """All suppliers, moved where the balance is below 5000."""
    return load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") < 5000, F.lit("MOVED"))
        .otherwise(F.col("s_nationkey").cast("string"))
        .alias("city"),
    )


def hot_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with supplier 0 on all larger quantities, about four fifths of the rows."""
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_quantity") > 10, F.lit(0).cast("bigint"))
        .otherwise(F.col("l_suppkey"))
        .alias("s_suppkey"),
    )


def account_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as one version from 1990 on, closed in 1991 for those with a negative balance."""
    open_account = F.col("c_acctbal") >= 0
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.lit(dt.date(1990, 1, 1)).alias("eff_start"),
        F.when(open_account, F.lit(dt.date(9999, 12, 31))).otherwise(F.lit(dt.date(1991, 1, 1))).alias("eff_end"),
        open_account.alias("is_current"),
    )


def account_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a change of its customer on its day; all larger ones are changes of one new key."""
    return load(spark, folder, "orders").select(
        F.when(F.col("o_totalprice") > 150_000, F.lit(-1).cast("bigint")).otherwise(F.col("o_custkey")).alias("id"),
        F.lit("ordered").alias("name"),
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderdate").cast("date").alias("changed_on"),
        F.col("o_orderkey").alias("number"),
    )
