"""What the plans look like, and that hot keys are split."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from stratamart.functions.joins import left_join_split
from stratamart.functions.ordering import consecutive_ids
from stratamart.operators import gold, ingest
from stratamart.plans import direct
from stratamart.plans.variants import DECLARATIVE, PG
from stratamart.sources import sinks
from verification.registry import REGISTRY, Tables

FOLDER = "/root/testdata/sf0.001"
# These run jobs while being built; their plans only read the result back.
EAGER = re.compile(r"^(s[1-8]_|k\d|i[3468]_|q4|m10|m[24]_dated|st[1-6]_|st7_latest_stream)")


@contextmanager
def settings(spark, **conf):
    conf = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark):
    for name, build in REGISTRY.items():
        if not EAGER.match(name):
            text = plan(build(spark, FOLDER))
            assert not re.search(r"Python|Pandas|Arrow", text), name


@pytest.mark.parametrize("name", ["fx1_notebook_book", "fx2_declarative_book", "i5_to_usd"])
def test_books_are_broadcast(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(REGISTRY[name](spark, FOLDER))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(REGISTRY["g6_sales_region_pg"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lines = [s for s in schemas if "l_orderkey" in s]
    assert lines == ["l_orderkey:bigint"]
    assert any("o_totalprice" in s for s in schemas) and not any("o_orderdate" in s for s in schemas)


def test_bronze_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    Tables(spark, FOLDER).orders().write.parquet(path)
    orders = spark.read.parquet(path)
    text = plan(direct.order_totals(orders, Tables(spark, FOLDER).order_item(), variant=PG))
    assert "Not(EqualTo(order_status,cancelled))" in text


def test_inner_consumers_drop_the_unmatched_branch(spark):
    tables = Tables(spark, FOLDER)
    text = tables.order_silver(PG).where("quantity > 0").groupBy("product_id").count()
    assert "LeftAnti" not in plan(text) and "Union" not in plan(text)


def test_numbering_sorts_no_whole_input(spark):
    """Only the per-2**32 block offsets may pass through one partition."""
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        df = consecutive_ids(spark.range(1000).withColumnRenamed("id", "position"), "position", "n")
        text = plan(df)
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    below = text.split(single[0])[1].splitlines()[1]
    assert "_super" in below and "_super_n" in text


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    tables = Tables(spark, FOLDER)
    orders = sinks.save_bucketed(tables.orders(), "orders_bucketed", str(tmp_path / "o"), "order_id", 4)
    items = sinks.save_bucketed(tables.order_item(), "items_bucketed", str(tmp_path / "i"), "order_id", 4)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        totals = direct.order_totals(orders, items, variant=PG)
        assert "Exchange" not in plan(totals)
        expected = direct.order_totals(tables.orders(), tables.order_item(), variant=PG)
        assert totals.agg(F.sum("amount")).first() == expected.agg(F.sum("amount")).first()
    spark.sql("DROP TABLE orders_bucketed")
    spark.sql("DROP TABLE items_bucketed")


def test_small_batch_does_not_shuffle_the_target(spark):
    tables = Tables(spark, FOLDER)
    batch = tables.payments_mapped().cache()
    batch.count()
    with settings(spark, spark__sql__adaptive__enabled="true"):
        df = ingest.classify(batch, tables.payment())
        df.collect()
        text = plan(df)
    batch.unpersist()
    assert re.search(r"BroadcastHashJoin .*LeftSemi", text)


def _final_plan(df):
    df.collect()
    return plan(df)


HOT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__shuffle__partitions": "32",
}


def _hot_sides(spark):
    """Right side with a third of its rows under key 0."""
    left = spark.range(0, 3000, numPartitions=8).select(F.col("id").alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 90_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2500).alias("k"), F.col("id").alias("b")
    )
    return left, right


def test_orders_are_joined_once(spark):
    lines = plan(REGISTRY["v3_order_declarative"](spark, FOLDER))
    assert "LeftAnti" not in lines
    assert len(re.findall(r"FileScan parquet .*?lineitem", lines)) == 1
    frequency = plan(REGISTRY["a6_order_frequency_histogram"](spark, FOLDER))
    assert "lineitem" not in frequency


def test_hot_right_key_is_split(spark):
    left, right = _hot_sides(spark)
    with settings(spark, **HOT):
        split = left_join_split(left, right, "k")
        assert "skew=true" in _final_plan(split)
        plain = left.join(right, "k", "left")
        assert "skew=true" not in _final_plan(plain)
        assert split.count() == plain.count()
        assert split.agg(F.sum("a"), F.sum("b")).first() == plain.agg(F.sum("a"), F.sum("b")).first()


def test_hot_key_is_split_below_an_aggregation_on_it(spark):
    left, right = _hot_sides(spark)
    with settings(spark, **HOT):
        joined = left.join(right, "k").groupBy("k").agg(F.sum("b").alias("b"), F.count("*").alias("n"))
        assert "skew=true" in _final_plan(joined)


def test_hot_customer_and_product(spark):
    """A third of all orders from one customer, a third of all lines for one product and one order."""
    tables = Tables(spark, FOLDER)

    class Hot(Tables):
        def orders(self):
            return tables.orders().withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("customer_id")))

        def order_item(self):
            hot = F.col("order_item_id") % 3 == 0
            return (
                tables.order_item()
                .withColumn("product_id", F.when(hot, 2).otherwise(F.col("product_id")))
                .withColumn("order_id", F.when(hot, 1).otherwise(F.col("order_id")))
            )

    hot = Hot(spark, FOLDER)
    for variant in (PG, DECLARATIVE):
        lines = hot.order_silver(variant)
        naive = (
            gold.non_cancelled(lines)
            .join(hot.customer_silver(variant), "customer_id")
            .groupBy("country")
            .agg(F.round(F.sum(variant.sales_amount), 2), F.count_distinct("order_id"), F.count_distinct("customer_id"))
        )
        direct = hot.sales_country(variant).withColumn("total_sales", F.round("total_sales", 2))
        assert {tuple(map(str, r)) for r in direct.collect()} == {tuple(map(str, r)) for r in naive.collect()}
