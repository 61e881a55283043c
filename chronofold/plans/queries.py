"""One query per operator, each over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronofold.operators import aggregate, changelog, dedup, jsontext, merge, nested, scd2, skew, topn
from chronofold.plans import inputs
from chronofold.plans.inputs import AS_OF, CUSTOMER_DIM, ORDER_DIM
from chronofold.sources import buckets, dimension, tables
from chronofold.sources.scratch import freeze, new_folder, new_schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Nested records


def flat_shipments(spark: SparkSession, folder: str, outer: bool) -> DataFrame:
    return nested.flatten_records(
        inputs.shipments(spark, folder),
        "items",
        inputs.SHIPMENT_PARENTS,
        inputs.SHIPMENT_ITEMS,
        outer,
    )


@query
def nested_explode_outer(spark, folder):
    return flat_shipments(spark, folder, outer=True)


@query
def nested_explode_inner(spark, folder):
    return flat_shipments(spark, folder, outer=False)


@query
def nested_explode_position(spark, folder):
    return nested.flatten_records(
        inputs.document_records(spark, folder),
        "lines",
        {"doc_id": "doc_id", "lang": "meta.lang", "source": "meta.source"},
        {"body": "body", "n_chars": "n"},
        position="line_no",
    )


@query
def nested_filter_parents(spark, folder):
    return flat_shipments(spark, folder, outer=True).where("ship_status = 'O'")


@query
def nested_row_counts(spark, folder):
    """Rows before the explode, and after each of its two forms, from one pass."""
    items = F.size("items")
    present = F.when(items > 0, items).otherwise(0)
    return inputs.shipments(spark, folder).agg(
        F.count("*").alias("records"),
        F.sum(F.greatest(present, F.lit(1))).alias("outer_rows"),
        F.sum(present).alias("inner_rows"),
    )


@query
def nested_flatten_structs(spark, folder):
    return nested.flatten_structs(inputs.located_customers(spark, folder))


@query
def nested_map_explode(spark, folder):
    customers = tables.load(spark, folder, "customer").select(
        "c_custkey",
        F.create_map(
            F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")
        ).alias("attributes"),
    )
    return nested.explode_map(customers, "attributes", ["c_custkey"])


# JSON text


@query
def json_parse_explode(spark, folder):
    return jsontext.flatten_json(
        inputs.shipment_messages(spark, folder),
        "raw_json",
        inputs.SHIPMENT_SCHEMA,
        "items",
        inputs.SHIPMENT_PARENTS,
        inputs.SHIPMENT_ITEMS,
    )


@query
def nested_explode_scalars(spark, folder):
    """The lines of every document, as an array of plain strings."""
    lines = tables.load(spark, folder, "documents").selectExpr(
        "doc_id", "split(text, '\n') as lines"
    )
    return nested.flatten_records(lines, "lines", {"doc_id": "doc_id"}, {"line": ""}, position="n")


@query
def json_nested_items(spark, folder):
    """Structs inside the elements of an array in JSON text, reached by paths."""
    parts = tables.load(spark, folder, "part").selectExpr(
        "to_json(named_struct('brand', p_brand, 'made', array("
        "named_struct('id', p_partkey, 'is', named_struct('kind', p_type, 'size', p_size))))) as raw"
    )
    schema = (
        "brand string, made array<struct<id: bigint, is: struct<kind: string, size: int>>>"
    )
    return jsontext.flatten_json(
        parts, "raw", schema, "made", {"brand": "brand"}, {"id": "id", "size": "is.size"}
    )


@query
def json_event_props(spark, folder):
    events = tables.load(spark, folder, "events")
    return jsontext.parse_json(events, "props", "k INT", keep=["event_id"])


@query
def json_inferred_schema(spark, folder):
    events = tables.load(spark, folder, "events")
    schema = jsontext.infer_json_schema(events, "props")
    return jsontext.parse_json(events, "props", schema, keep=["event_id"])


def drifting_messages(spark: SparkSession, folder: str) -> list[DataFrame]:
    """JSON text of three shapes, as batches of one feed: more fields, wider numbers, other fields in a struct."""
    events = tables.load(spark, folder, "events").selectExpr("'event' as kind", "event_id as id", "props as raw")
    orders = tables.load(spark, folder, "orders").selectExpr(
        "'order' as kind",
        "o_orderkey as id",
        "to_json(named_struct('k', o_custkey, 'status', o_orderstatus, 'detail', named_struct('priority', o_orderpriority))) as raw",
    )
    parts = tables.load(spark, folder, "part").selectExpr(
        "'part' as kind",
        "p_partkey as id",
        "to_json(named_struct('detail', named_struct('brand', p_brand, 'size', p_size), 'k', p_size + 0.5D, 'status', null)) as raw",
    )
    return [events, orders, parts]


@query
def json_schema_evolved(spark, folder):
    """All batches, parsed by the schema that has grown with them."""
    table = f"{new_schema(spark, "chronofold")}.feed_schema"
    batches = drifting_messages(spark, folder)
    for batch in batches:
        schema = jsontext.evolve_json_schema(batch, "raw", table)
    parsed = [jsontext.parse_json(b, "raw", schema, keep=["kind", "id"]) for b in batches]
    every = parsed[0].unionByName(parsed[1]).unionByName(parsed[2])
    return nested.flatten_structs(every)


@query
def json_schema_changes(spark, folder):
    table = f"{new_schema(spark, "chronofold")}.feed_schema"
    for batch in drifting_messages(spark, folder):
        jsontext.evolve_json_schema(batch, "raw", table)
    return spark.table(table).select("batch", F.explode("changes").alias("change"))


@query
def json_variant_explode(spark, folder):
    """The same rows as by a schema, found without one."""
    return jsontext.flatten_variant(
        inputs.shipment_messages(spark, folder),
        "raw_json",
        "$.items",
        {"order_id": ("$.order_id", "bigint"), "ship_flag": ("$.ship.flag", "string"), "ship_status": ("$.ship.status", "string")},
        {"product": ("$.product", "bigint"), "qty": ("$.qty", "double"), "price": ("$.price", "double")},
    )


def mixed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Event properties, which are JSON, together with documents, which are prose."""
    events = tables.load(spark, folder, "events").select(
        F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("props").alias("raw")
    )
    documents = tables.load(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("raw")
    )
    return events.unionByName(documents)


@query
def json_rejects(spark, folder):
    parsed = jsontext.parse_json(
        mixed_messages(spark, folder), "raw", "k INT", keep=["kind", "id"], corrupt="raw_text"
    )
    return jsontext.split_rejects(parsed, "raw_text")[1].select("kind", "id", "raw_text")


@query
def json_accepted(spark, folder):
    parsed = jsontext.parse_json(
        mixed_messages(spark, folder), "raw", "k INT", keep=["kind", "id"], corrupt="raw_text"
    )
    return jsontext.split_rejects(parsed, "raw_text")[0]


# Dimension history


def customer_case(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return inputs.customer_dimension(spark, folder), inputs.customer_feed(spark, folder)


@query
def scd2_changed(spark, folder):
    return scd2.scd2_changed(*customer_case(spark, folder), CUSTOMER_DIM)


@query
def scd2_new(spark, folder):
    return scd2.scd2_new(*customer_case(spark, folder), CUSTOMER_DIM)


@query
def scd2_classify(spark, folder):
    return scd2.scd2_classify(*customer_case(spark, folder), CUSTOMER_DIM, as_of=AS_OF)


@query
def scd2_expire(spark, folder):
    return scd2.scd2_expire(*customer_case(spark, folder), CUSTOMER_DIM, AS_OF)


@query
def scd2_apply(spark, folder):
    return scd2.scd2_apply(*customer_case(spark, folder), CUSTOMER_DIM, AS_OF)


@query
def scd2_apply_reopen(spark, folder):
    return scd2.scd2_apply(*customer_case(spark, folder), CUSTOMER_DIM, AS_OF, reopen_closed=True)


@query
def scd2_apply_shuffled(spark, folder):
    """The plan for a batch too large to broadcast."""
    return scd2.scd2_apply(*customer_case(spark, folder), CUSTOMER_DIM, AS_OF, broadcast_bytes=0)


@query
def scd2_apply_orders(spark, folder):
    return scd2.scd2_apply(
        inputs.order_dimension(spark, folder), inputs.order_feed(spark, folder), ORDER_DIM, AS_OF
    )


@query
def scd2_long_history(spark, folder):
    """A dimension with most of its versions on one key."""
    return scd2.scd2_apply(
        inputs.supplier_dimension(spark, folder),
        inputs.supplier_feed(spark, folder),
        CUSTOMER_DIM,
        AS_OF,
    )


@query
def scd2_long_history_shuffled(spark, folder):
    return scd2.scd2_apply(
        inputs.supplier_dimension(spark, folder),
        inputs.supplier_feed(spark, folder),
        CUSTOMER_DIM,
        AS_OF,
        broadcast_bytes=0,
    )


@query
def scd2_long_history_violations(spark, folder):
    return scd2.scd2_check(inputs.supplier_dimension(spark, folder), CUSTOMER_DIM)


@query
def scd2_actions(spark, folder):
    actions = scd2.scd2_actions(
        inputs.order_dimension(spark, folder), inputs.order_feed(spark, folder), ORDER_DIM, AS_OF
    )
    return actions.groupBy("action").agg(F.count("*").alias("versions"))


@query
def scd2_metrics(spark, folder):
    return scd2.scd2_metrics(scd2_classify(spark, folder))


@query
def scd2_rerun(spark, folder):
    target, batch = customer_case(spark, folder)
    once = freeze(scd2.scd2_apply(target, batch, CUSTOMER_DIM, AS_OF))
    return scd2.scd2_apply(once, batch, CUSTOMER_DIM, AS_OF)


@query
def scd2_same_day(spark, folder):
    target, batch = customer_case(spark, folder)
    again = inputs.customer_feed(spark, folder, moved="MOVED2")
    once = freeze(scd2.scd2_apply(target, batch, CUSTOMER_DIM, AS_OF))
    return scd2.scd2_apply(once, again, CUSTOMER_DIM, AS_OF)


@query
def scd2_change_log(spark, folder):
    """All orders as changes, many of them of one key."""
    log = inputs.account_log(spark, folder)
    return changelog.scd2_change_log(
        inputs.account_dimension(spark, folder), log, CUSTOMER_DIM, "changed_on", {"number": "desc"}
    )


@query
def scd2_change_log_shuffled(spark, folder):
    log = inputs.account_log(spark, folder)
    return changelog.scd2_change_log(
        inputs.account_dimension(spark, folder), log, CUSTOMER_DIM, "changed_on", {"number": "desc"}, broadcast_bytes=0
    )


def late_customers(spark: SparkSession, folder: str, **options) -> DataFrame:
    """What was so in October, told after the change of June: before it for known keys, before the first version of others."""
    target, batch = customer_case(spark, folder)
    applied = freeze(scd2.scd2_apply(target, batch, CUSTOMER_DIM, AS_OF))
    late = inputs.customer_feed(spark, folder, moved="LATE").withColumn("since", F.lit(dt.date(2023, 10, 1)))
    more = late.where("city = 'LATE'").withColumns({"since": F.lit(dt.date(2024, 6, 1)), "city": F.lit("LATER")})
    return changelog.scd2_apply_late(applied, late.unionByName(more), CUSTOMER_DIM, "since", **options)


@query
def scd2_apply_late(spark, folder):
    return late_customers(spark, folder)


@query
def scd2_apply_late_shuffled(spark, folder):
    return late_customers(spark, folder, broadcast_bytes=0)


@query
def scd2_classify_same_day(spark, folder):
    """What a second batch of the day does."""
    target, batch = customer_case(spark, folder)
    again = inputs.customer_feed(spark, folder, moved="MOVED2")
    once = freeze(scd2.scd2_apply(target, batch, CUSTOMER_DIM, AS_OF))
    return scd2.scd2_classify(once, again, CUSTOMER_DIM, as_of=AS_OF)


@query
def scd2_metrics_same_day(spark, folder):
    return scd2.scd2_metrics(scd2_classify_same_day(spark, folder))


@query
def scd2_reopen_late(spark, folder):
    """Versions reopened before they ended, which only "keep" allows, overlap."""
    target, batch = customer_case(spark, folder)
    day = dt.date(2023, 6, 1)
    options = {"reopen_closed": True, "same_day": "keep"}
    late = scd2.scd2_apply(target, batch, CUSTOMER_DIM, day, **options)
    return scd2.scd2_check(late, CUSTOMER_DIM)


@query
def scd2_missing_dates(spark, folder):
    """Versions without a start or an end."""
    broken = inputs.order_dimension(spark, folder).withColumns(
        {
            "eff_start": F.expr("if(priority = '1-URGENT', null, eff_start)"),
            "eff_end": F.expr("if(status = 'P', null, eff_end)"),
            "is_current": F.expr("if(status = 'P', null, is_current)"),
        }
    )
    return scd2.scd2_check(broken, ORDER_DIM).where("rule = 'missing_date'")


@query
def append_history(spark, folder):
    """Appends are listed with their rows, and versions before them stay as they were."""
    target, batch = customer_case(spark, folder)
    table = f"{new_schema(spark, "chronofold")}.customer_list"
    tables.publish(target.select("id", "name", "city"), table)
    tables.append_rows(batch, table)
    tables.append_rows(target, table)
    return tables.history(spark, table).select(
        "version", "operation", F.col("metrics")["rows"].cast("bigint").alias("rows")
    )


@query
def scd2_violations(spark, folder):
    return scd2.scd2_check(scd2_apply(spark, folder), CUSTOMER_DIM)


@query
def scd2_violations_found(spark, folder):
    """The rules on history that breaks them: order versions listed under their customer."""
    broken = inputs.order_dimension(spark, folder).withColumnRenamed("customer_id", "id")
    return scd2.scd2_check(broken, CUSTOMER_DIM)


@query
def scd2_ordered(spark, folder):
    return scd2.scd2_ordered(scd2_apply(spark, folder), CUSTOMER_DIM)


# Keyed merges


def moved(target: DataFrame, batch: DataFrame, **options) -> DataFrame:
    changes = {"city": "s.city"}
    when = "t.is_current and s.city <> t.city"
    return merge.merge_update(target, batch, ["id"], set=changes, when=when, **options)


def upserted(target: DataFrame, batch: DataFrame, **options) -> DataFrame:
    given = {"name": "s.name", "city": "s.city"}
    opened = {"eff_start": F.lit(AS_OF), "eff_end": "date '9999-12-31'", "is_current": "true"}
    values = {"id": "s.id", **given, **opened}
    return merge.merge_upsert(target, batch, ["id"], set=given, values=values, **options)


def overwritten(target: DataFrame, batch: DataFrame, **options) -> DataFrame:
    return merge.scd1_apply(target.select("id", "name", "city"), batch, ["id"], **options)


@query
def merge_update(spark, folder):
    return moved(*customer_case(spark, folder))


@query
def merge_upsert(spark, folder):
    return upserted(*customer_case(spark, folder))


@query
def scd1_apply(spark, folder):
    return overwritten(*customer_case(spark, folder))


# The plans for batches that are too large to broadcast.


@query
def merge_update_shuffled(spark, folder):
    return moved(*customer_case(spark, folder), broadcast_bytes=0)


@query
def merge_upsert_shuffled(spark, folder):
    return upserted(*customer_case(spark, folder), broadcast_bytes=0)


@query
def scd1_apply_shuffled(spark, folder):
    return overwritten(*customer_case(spark, folder), broadcast_bytes=0)


@query
def scd2_classify_shuffled(spark, folder):
    options = {"broadcast_bytes": 0, "as_of": AS_OF}
    return scd2.scd2_classify(*customer_case(spark, folder), CUSTOMER_DIM, **options)


@query
def scd2_expire_shuffled(spark, folder):
    return scd2.scd2_expire(*customer_case(spark, folder), CUSTOMER_DIM, AS_OF, broadcast_bytes=0)


# Tables


@query
def publish_roundtrip(spark, folder):
    """Publish a dimension, then replace it by a plan that reads it."""
    target, batch = customer_case(spark, folder)
    table = f"{new_schema(spark, "chronofold")}.dim_customer"
    tables.publish(target, table)
    tables.publish(scd2.scd2_apply(spark.table(table), batch, CUSTOMER_DIM, AS_OF), table)
    return spark.table(table)


@query
def publish_flat_items(spark, folder):
    """Flatten nested messages into a table."""
    table = f"{new_schema(spark, "chronofold")}.fact_items"
    tables.publish(json_parse_explode(spark, folder), table)
    return spark.table(table)


@query
def append_by_name(spark, folder):
    """Append rows whose columns come in another order."""
    target, batch = customer_case(spark, folder)
    table = f"{new_schema(spark, "chronofold")}.customer_list"
    tables.publish(target.select("id", "name", "city"), table)
    tables.append_rows(batch.select("city", "id", "name"), table)
    return spark.table(table)


def committed_orders(spark: SparkSession, folder: str) -> str:
    table = f"{new_schema(spark, "chronofold")}.dim_order"
    dimension.create_dimension(inputs.order_dimension(spark, folder), table, ORDER_DIM)
    dimension.commit_dimension(spark, table, inputs.order_feed(spark, folder), ORDER_DIM, AS_OF)
    return table


@query
def dimension_commit(spark, folder):
    return spark.table(committed_orders(spark, folder))


@query
def dimension_history(spark, folder):
    counts = ["expired", "inserted_changed", "inserted_new", "unchanged"]
    return tables.history(spark, committed_orders(spark, folder)).select(
        "version",
        "operation",
        *[F.col("metrics")[c].cast("bigint").alias(c) for c in counts],
    )


@query
def dimension_commit_buckets(spark, folder):
    """Three commits, each with the orders of some priorities: changes in a few buckets' worth of rows, then all."""
    table = f"{new_schema(spark, "chronofold")}.dim_order"
    buckets.create_bucketed(inputs.order_dimension(spark, folder), table, ORDER_DIM)
    feed = inputs.order_feed(spark, folder)
    for part in ("priority = '1-URGENT' and status = 'P'", "priority = '1-URGENT' and status <> 'P'", "priority <> '1-URGENT'"):
        buckets.commit_bucketed(spark, table, feed.where(part), ORDER_DIM, AS_OF)
    return spark.table(table)


def replayed_customers(spark: SparkSession, folder: str) -> str:
    """A feed, a later one that changes the same customers again, and then the first one once more."""
    table = f"{new_schema(spark, "chronofold")}.dim_customer"
    target, first = customer_case(spark, folder)
    buckets.create_bucketed(target, table, CUSTOMER_DIM)
    second = inputs.customer_feed(spark, folder, moved="MOVED2")
    for feed, month in ((first, 6), (second, 7), (first, 8)):
        day = dt.date(2024, month, 1)
        buckets.commit_bucketed(spark, table, feed, CUSTOMER_DIM, day, skip_replays=True)
    return table


@query
def dimension_replay(spark, folder):
    return spark.table(replayed_customers(spark, folder))


@query
def dimension_replay_history(spark, folder):
    listed = tables.history(spark, replayed_customers(spark, folder))
    counts = ["expired", "inserted_new", "unchanged"]
    return listed.select("version", "operation", *[F.col("metrics")[c].cast("bigint").alias(c) for c in counts])


@query
def dimension_rejected(spark, folder):
    """A feed dated before the versions it changes, which would end before they began, is not let through."""
    table = f"{new_schema(spark, "chronofold")}.dim_customer"
    target, feed = customer_case(spark, folder)
    buckets.create_bucketed(target, table, CUSTOMER_DIM)
    options = {"same_day": "keep", "check": True}
    buckets.commit_bucketed(spark, table, feed, CUSTOMER_DIM, dt.date(2022, 6, 1), **options)
    buckets.commit_bucketed(spark, table, feed, CUSTOMER_DIM, AS_OF, **options)
    return spark.table(table)


@query
def frozen_changes(spark, folder):
    """A change set stays as it was when the table it came from changes."""
    target, batch = customer_case(spark, folder)
    table = f"{new_schema(spark, "chronofold")}.dim_customer"
    tables.publish(target, table)
    current = spark.table(table)
    changes = freeze(scd2.scd2_changed(current, batch, CUSTOMER_DIM))
    tables.publish(scd2.scd2_apply(current, batch, CUSTOMER_DIM, AS_OF), table)
    return scd2.scd2_open_rows(changes, CUSTOMER_DIM, AS_OF)


# Deduplication


@query
def dedup_latest(spark, folder):
    return dedup.keep_latest(
        tables.load(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        {"l_shipdate": "desc", "l_partkey": "asc", "l_suppkey": "asc", "l_extendedprice": "asc"},
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query
def dedup_documents(spark, folder):
    return dedup.first_copies(tables.load(spark, folder, "documents"), ["text"], "doc_id")


@query
def dedup_rows(spark, folder):
    keys = tables.load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return dedup.drop_exact_copies(keys)


# Top N per group


@query
def topn_row_number(spark, folder):
    part = tables.load(spark, folder, "part").select("p_brand", "p_partkey", "p_size")
    return topn.top_rows(part, 3, ["p_brand"], {"p_size": "desc", "p_partkey": "asc"}, "rn")


@query
def topn_rank(spark, folder):
    part = tables.load(spark, folder, "part").select("p_brand", "p_partkey", "p_size")
    return topn.top_ranked(part, 3, ["p_brand"], {"p_size": "desc"}, column="rnk")


@query
def topn_dense_rank(spark, folder):
    part = tables.load(spark, folder, "part").select("p_brand", "p_partkey", "p_size")
    return topn.top_ranked(part, 3, ["p_brand"], {"p_size": "desc"}, dense=True, column="rnk")


@query
def topn_row_number_large(spark, folder):
    """More rows per group than Spark limits before the shuffle."""
    events = tables.load(spark, folder, "events").select("event_id", "event_type", "value")
    return topn.top_rows(events, 1500, ["event_type"], {"value": "desc", "event_id": "asc"}, "rn")


@query
def topn_rank_salted(spark, folder):
    """What runs where the table of best values is too large to broadcast."""
    part = tables.load(spark, folder, "part").select("p_brand", "p_size", "p_partkey")
    order = {"p_size": "desc"}
    return topn.top_ranked(part, 3, ["p_brand"], order, column="rnk", broadcast_bytes=0)


@query
def topn_dense_rank_salted(spark, folder):
    part = tables.load(spark, folder, "part").select("p_brand", "p_size", "p_partkey")
    order = {"p_size": "desc"}
    return topn.top_ranked(part, 3, ["p_brand"], order, True, "rnk", broadcast_bytes=0)


@query
def topn_pruned(spark, folder):
    """Top orders of one status, from a copy of the table that is partitioned by status."""
    stored = new_folder(spark, "orders")
    orders = tables.load(spark, folder, "orders")
    orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy(
        "o_orderstatus"
    ).parquet(stored)
    finished = spark.read.parquet(stored).where("o_orderstatus = 'F'")
    return topn.top_ranked(finished, 5, ["o_orderstatus"], {"o_totalprice": "desc"}, column="rnk")


def stored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in a partition for each nation."""
    stored = new_folder(spark, "customers")
    customers = tables.load(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    customers.repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(stored)
    return spark.read.parquet(stored)


@query
def topn_dynamic_pruned(spark, folder):
    """The richest customers of each nation of two regions; the nations are looked up in other tables."""
    region = tables.load(spark, folder, "region").where("r_name in ('EUROPE', 'ASIA')")
    nation = tables.load(spark, folder, "nation")
    wanted = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr("n_nationkey as c_nationkey")
    order = {"c_acctbal": "desc", "c_custkey": "asc"}
    return topn.top_rows_of(stored_customers(spark, folder), wanted, 3, ["c_nationkey"], order, "rn")


# Aggregates and joins on a hot key


SUPPLIED = {
    "lines": aggregate.Measure("count"),
    "quantity": aggregate.Measure("sum", "l_quantity"),
    "least": aggregate.Measure("min", "l_quantity"),
    "most": aggregate.Measure("max", "l_quantity"),
    "orders": aggregate.Measure("distinct", "l_orderkey"),
    "about": aggregate.Measure("approx_distinct", "l_orderkey", size=14),
    "median": aggregate.Measure("quantile", "l_quantity", 0.5, size=1000),
}


@query
def skew_salted_aggregate(spark, folder):
    """Measures of each supplier's lines, most of which one supplier has; of the sketches how near they come."""
    found = aggregate.salted_aggregate(inputs.hot_lineitem(spark, folder), ["s_suppkey"], SUPPLIED)
    near = "abs(about - orders) <= 0.05 * orders + 1 as near"
    # no value of the middle is missed by more than the sketch's share of ranks: quantities above 10 lie evenly to 50
    middle = "if(s_suppkey = 0, abs(median - 30.5) <= 1.5, median between least and most) as middle"
    return found.selectExpr("s_suppkey", "lines", "quantity", "least", "most", "orders", near, middle)


def supplier_names(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "supplier").select("s_suppkey", "s_name")


@query
def skew_salted_join(spark, folder):
    """A part for each 64th of the rows, so the hot key is dealt into about fifty."""
    lines = inputs.hot_lineitem(spark, folder)
    share = lines.count() // 64 + 1
    return skew.salted_join(lines, supplier_names(spark, folder), ["s_suppkey"], "inner", share)


def coded_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the supplier's key as text, of two widths."""
    code = "lpad(cast(s_suppkey as string), if(l_quantity > 30, 7, 12), '0')"
    return inputs.hot_lineitem(spark, folder).withColumn("s_suppkey", F.expr(code))


@query
def skew_mixed_types(spark, folder):
    """Text with leading zeros against numbers, both spellings of the hot key dealt out."""
    lines = coded_lineitem(spark, folder)
    share = lines.count() // 64 + 1
    return skew.salted_join(lines, supplier_names(spark, folder), ["s_suppkey"], "left", share)


@query
def merge_upsert_mixed_types(spark, folder):
    """Orders under their customer as text, with zeros before, and a feed with numbers."""
    target = tables.load(spark, folder, "orders").selectExpr(
        "lpad(cast(o_custkey as string), 9, '0') as id", "o_orderkey as number", "o_orderpriority as name"
    )
    feed = inputs.customer_feed(spark, folder).select("id", "name")
    return merge.merge_upsert(
        target,
        feed,
        ["id"],
        set={"name": "s.name"},
        values={"id": "s.id", "name": "s.name"},
        broadcast_bytes=0,
        rows_per_salt=10,
    )


@query
def skew_both_hot(spark, folder):
    """The hot supplier key against all nations under that key: hot on both sides."""
    names = supplier_names(spark, folder).unionByName(
        tables.load(spark, folder, "nation").selectExpr("0L as s_suppkey", "n_name as s_name")
    )
    lines = inputs.hot_lineitem(spark, folder)
    joined = skew.salted_join(lines, names, ["s_suppkey"], "inner", names.count() // 16 + 1)
    return joined.groupBy("s_name").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity")
    )


@query
def skew_broadcast_fallback(spark, folder):
    """What runs where the other side is too large to broadcast."""
    lines, names = inputs.hot_lineitem(spark, folder), supplier_names(spark, folder)
    return skew.broadcast_join(lines, names, ["s_suppkey"], broadcast_bytes=0)


@query
def skew_broadcast_join(spark, folder):
    return skew.broadcast_join(
        inputs.hot_lineitem(spark, folder), supplier_names(spark, folder), ["s_suppkey"]
    )


@query
def skew_aqe_join(spark, folder):
    return skew.adaptive_join(
        inputs.hot_lineitem(spark, folder), supplier_names(spark, folder), ["s_suppkey"]
    )
