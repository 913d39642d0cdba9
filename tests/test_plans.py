"""The plans Spark makes: what is read, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers all queries)
from brookmart.operators import devices, firstorder, hot, keyed, orderwide
from brookmart.plans import queries as batch, warehouse
from brookmart.session import work_dir
from brookmart.sinks import ledger
from brookmart.sources import shop, tables


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


BATCH = [n for n in batch.QUERIES if not n.startswith(("stream_", "sink_", "fan_", "layers_", "raw_", "sliding_"))]


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_cross_join_no_python_no_collect(spark, sf, name):
    text = plan(batch.QUERIES[name](spark, sf))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas|ObjectHashAggregate\(keys=\[\]", text)


def test_columns_and_filters_reach_the_scan(spark, sf):
    text = plan(tables.get_document(shop.table(spark, sf, "documents"), "doc_id", 7).select("doc_id", "lang"))
    assert "EqualTo(doc_id,7)" in text and "ReadSchema: struct<doc_id:bigint,lang:string>" in text
    text = plan(shop.orders(spark, sf, (shop.DAY,)).select("id"))
    assert re.search(r"(EqualTo|In)\(o_orderdate", text) and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_day_folders_are_pruned(spark):
    path = work_dir(spark, "t")
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt string, v int")
    ledger.write_batch(rows, path, 0, by=("dt",))
    one = ledger.read_latest(spark, path, rows.schema, ["dt", "v"]).where("dt = '2024-01-01'")
    assert "2024-01-01" in re.search(r"PartitionFilters: \[(.*?)\]", plan(one)).group(1)
    assert one.count() == 1


def test_allocation_shuffles_each_side_once(spark, sf):
    """Numbering, join and running sums of the lines share one shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = shop.orders(spark, sf).withColumn("original_total_amount", F.col("final_total_amount"))
        rows = orderwide.split_payment(orderwide.order_wide(orders, shop.order_details(spark, sf)))
        text = plan(rows.select("order_id", "order_detail_id", "final_cents"))
        assert text.count("Exchange hashpartitioning") == 2 and "BroadcastExchange" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_of_orders_are_taken_where_lines_are_numbered(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = shop.with_order_sum(shop.order_details(spark, sf))
        rows = orderwide.order_wide(shop.orders(spark, sf), lines)
        want = orderwide.order_wide(shop.with_original_amount(shop.orders(spark, sf), spark, sf),
                                    shop.order_details(spark, sf))
        assert plan(rows).count("Exchange hashpartitioning") == 2
        what = ["order_id", "order_detail_id", "original_total_amount"]
        assert rows.schema["original_total_amount"].dataType == want.schema["original_total_amount"].dataType
        assert sorted(map(tuple, rows.select(what).collect())) == sorted(map(tuple, want.select(what).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_rows_combine_before_the_shuffle(spark, sf):
    for rows in (warehouse.first_seen(spark, sf), firstorder.first_orders(shop.orders(spark, sf)),
                 devices.new_devices(warehouse.start_records(spark, sf))):
        assert "partial_min" in plan(rows)


def test_hot_orders_are_spread_over_tasks(spark):
    """A third of all lines belong to one order; no task gets them all."""
    n = 9000
    lines = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("order_id"),
        F.lit(1.0).alias("detail_amount"))
    orders = lines.groupBy(F.col("order_id").alias("id")).agg(
        F.sum("detail_amount").alias("original_total_amount"), F.lit(10.0).alias("final_total_amount"))
    large = hot.hot_keys(lines, "order_id", more_than=100)
    assert [tuple(r)[:2] for r in large.collect()] == [(0, 30)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paid = orderwide.split_payment(orderwide.order_wide(orders, lines, large), large)
        sizes = [r["count"] for r in paid.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 2
        wrong = paid.groupBy("order_id").agg(F.sum("final_cents").alias("s")).where("s <> 1000").count()
        assert wrong == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_product_is_split_at_run_time(spark):
    """A lookup too large to broadcast splits a hot key (skew join)."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    from brookmart.operators.lookups import lookup
    rows = spark.range(60000).repartition(8).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("sku_id"))
    dim = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("name"))
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = lookup(rows, "sku_id", dim, "id", {"tm_name": F.col("name")})
        got = out.collect()
        assert len(got) == 60000 and sum(r.tm_name is not None for r in got) == 31000
        assert "SortMergeJoin(skew=true)" in plan(out)
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_keyed_rows_do_not_collect(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    assert "collect_list" not in plan(keyed.last_per_key(rows, ["k"], ["id"]))
