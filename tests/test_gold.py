import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.functions.geography import COUNTRY_NAMES, map_region
from stratamart.operators import analysis, gold, silver
from stratamart.plans import direct
from stratamart.plans.variants import DECLARATIVE, NOTEBOOK, PG
from stratamart.session import configure
from verification.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark):
    return Tables(spark, FOLDER)


def _rounded(df):
    return sorted(
        tuple(round(float(v), 4) if isinstance(v, (Decimal, float)) else v for v in row) for row in df.collect()
    )


@pytest.mark.parametrize("variant", [PG, NOTEBOOK, DECLARATIVE], ids=lambda v: v.name)
def test_direct_plans_equal_silver_plans(tables, variant):
    lines, customers = tables.order_silver(variant), tables.customer_silver(variant)
    assert _rounded(tables.sales_region(variant)) == _rounded(gold.sales_region(lines, customers, variant))
    products = tables.product_silver(variant)
    if variant == DECLARATIVE:
        assert _rounded(tables.product_profit()) == _rounded(gold.product_profit(products, lines))
    else:
        assert _rounded(tables.product_revenue(variant)) == _rounded(gold.product_revenue(products, lines, variant))


def test_direct_totals_count_every_payment_and_line(spark, rows):
    orders = spark.createDataFrame(
        [(1, 9, "completed", "Dollar", Decimal(10)), (2, 9, "completed", "Euro", Decimal(10)),
         (3, 9, "cancelled", "Euro", Decimal(10)), (4, 9, None, "Euro", Decimal(10))],
        "order_id bigint, customer_id bigint, order_status string, currency string, total_amount decimal(18,2)",
    )
    items = spark.createDataFrame(
        [(1, 5, 2), (1, 6, 3), (1, 6, 0), (2, 5, 1), (3, 5, 1)], "order_id bigint, product_id bigint, quantity int"
    )
    payments = spark.createDataFrame(
        [(1, Decimal("7.00")), (1, Decimal("1.00")), (3, Decimal("4.00"))], "order_id bigint, amount decimal(18,2)"
    )
    totals = direct.order_totals(orders, items, payments, DECLARATIVE)
    assert rows(totals) == [(1, 9, Decimal("16.00000000")), (2, 9, None)]
    lines = direct.lines_per_product(orders, items, payments, DECLARATIVE)
    assert rows(lines) == [(5, 5, Decimal("8.00000000")), (6, 6, Decimal("8.00000000"))]


def test_many_small_payments_equal_the_silver_sum(spark):
    """0, 1, 3 and 200 payments per order: every payment is rounded by itself in both forms."""
    orders = spark.createDataFrame(
        [(k, 9, "completed", "Yuan Renminbi", Decimal(10)) for k in (1, 2, 3, 4)],
        "order_id bigint, customer_id bigint, order_status string, currency string, total_amount decimal(18,2)",
    )
    header = orders.selectExpr("*", "1L shipping_address_id", "date'2024-01-01' order_date", "total_amount subtotal", "total_amount discount_amount")
    items = spark.createDataFrame([(k, 5, 2) for k in (1, 2, 3, 4)], "order_id bigint, product_id bigint, quantity int")
    paid = [(2, Decimal("1.37"))] + [(3, Decimal("0.01"))] * 3 + [(4, Decimal("0.01"))] * 200
    payments = spark.createDataFrame(paid, "order_id bigint, amount decimal(18,2)")
    lines = silver.order(header, items, payments, variant=DECLARATIVE)
    expected = {r.order_id: r.total for r in lines.groupBy("order_id").agg(F.sum("unified_amount").alias("total")).collect()}
    totals = {r.order_id: r.amount for r in direct.order_totals(orders, items, payments, DECLARATIVE).collect()}
    assert totals == expected and totals[1] is None


@pytest.mark.parametrize("seed", range(3))
def test_sales_by_place_against_brute_force(spark, seed):
    """Hot customer, several addresses per customer, and order ids shared between customers."""
    random.seed(seed)
    customers = [(c, random.choice(["X", "Y", None])) for c in range(6) for _ in range(random.randint(0, 3))]
    totals = list({(random.randint(0, 20), random.choice([0, 0, 0, 1, 2, 3, 4, 5])) for _ in range(40)})
    totals = [(o, c, Decimal(random.randint(1, 9))) for o, c in totals]
    expected = defaultdict(lambda: [Decimal(0), set(), set()])
    for o, c, amount in totals:
        for customer, place in customers:
            if customer == c:
                expected[place][0] += amount
                expected[place][1].add(o)
                expected[place][2].add(c)
    got = gold.sales_by(
        spark.createDataFrame(totals, "order_id int, customer_id int, amount decimal(18,2)"),
        spark.createDataFrame(customers, "customer_id int, place string"),
        "place",
    ).collect()
    assert {r["place"]: (r["total_sales"], r["order_count"], r["customer_count"]) for r in got} == {
        place: (amount, len(o), len(c)) for place, (amount, o, c) in expected.items()
    }


def test_keyed_counting_equals_distinct_counting(tables):
    totals, customers = tables.order_totals(PG), tables.customer_silver(PG)
    plain, keyed = (gold.sales_country_from_totals(totals, customers, flag) for flag in (False, True))
    assert _rounded(plain.na.fill("-")) == _rounded(keyed.na.fill("-"))


def test_allocated_revenue_adds_up(tables):
    lines = tables.order_item().join(tables.orders(), "order_id")
    products = tables.product_silver(NOTEBOOK)
    allocated = gold.product_revenue_allocated(products, lines, "total_amount").agg(F.sum("allocated_revenue")).first()[0]
    covered = lines.join(products, "product_id").where("quantity * price > 0").select("order_id").distinct()
    true_total = gold.non_cancelled(tables.orders()).join(covered, "order_id", "left_semi").agg(F.sum("total_amount")).first()[0]
    assert allocated == pytest.approx(float(true_total))


def test_cancelled_product_null_status_and_duplicate_product(spark, rows):
    products = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "product_id int, product_name string")
    lines = spark.createDataFrame(
        [(1, 1, "cancelled"), (2, 1, "completed"), (3, 1, None), (4, 1, "pending"), (5, None, "pending")],
        "order_id int, product_id int, order_status string",
    )
    assert rows(gold.cancelled_product(products, lines)) == [(1, "a", 2, 4, 0.25)]
    assert rows(gold.cancelled_product_orders(products, lines)) == [(1, "a", 1, 2, 0.25)]


def test_region_maps(spark):
    df = spark.createDataFrame([("DO",), ("BR",), ("MN",), ("AM",), ("ZW",), ("DE",), ("",), (None,)], "c string")
    narrow = [r[0] for r in df.select(map_region(F.col("c"), "narrow")).collect()]
    wide = [r[0] for r in df.select(map_region(F.col("c"), "wide", "Other (null)")).collect()]
    assert narrow == ["North America", "LATAM", "APAC", "EMEA", "Other", "Other", "Other", "Other"]
    assert wide == ["North America", "LATAM", "APAC", "EMEA", "EMEA", "Other (null)", "Other (null)", "Other (null)"]
    assert len(COUNTRY_NAMES) == 34


def test_currency_distribution_of_no_rows(tables):
    assert gold.currency_distribution(tables.payment_raw().where("payment_id < 0")).count() == 0


def test_profit_of_product_without_units(spark, rows):
    products = spark.createDataFrame(
        [(1, "a", "c", Decimal("1.00"), Decimal("2.00"))],
        "product_id int, product_name string, category_name string, price decimal(18,2), sell_price decimal(18,2)",
    )
    lines = spark.createDataFrame([(1, 1, 0, Decimal("0"), "done")], "order_id int, product_id int, quantity int, unified_amount decimal(28,8), order_status string")
    row = gold.product_profit(products, lines).first()
    assert row["unit_profit"] is None and row["profit_margin"] is None and row["total_profit"] == 0


def test_bucket_small_keeps_the_sum(spark):
    df = spark.createDataFrame([("a", 90), ("b", 8), ("c", 1), ("d", 1), (None, 50)], "k string, v int")
    got = {r["k"]: r["v"] for r in analysis.bucket_small(df, "k", "v", 0.05).collect()}
    assert got == {"a": 90, "b": 8, "Other": 2, None: 50}


def test_histogram_edges(spark):
    import numpy as np

    values = [0.0, 0.05, 0.5, 0.95, 1.0, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["product_count"] for r in analysis.histogram(df, "v", 20).orderBy("bin").collect()]
    assert got == np.histogram(values, bins=20)[0].tolist()
    constant = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    got = [r["product_count"] for r in analysis.histogram(constant, "v", 4).orderBy("bin").collect()]
    assert got == np.histogram([3.0, 3.0], bins=4)[0].tolist()
    assert analysis.histogram(df.where("v > 9"), "v", 20).count() == 0


def test_discount_average_ignores_unconverted_lines(spark, rows):
    lines = spark.createDataFrame(
        [(1, 0, Decimal("4")), (2, None, None), (3, 5, Decimal("6"))], "order_id int, discount_amount int, unified_amount decimal(28,8)"
    )
    got = {r[0]: (float(r[1]), r[2], r[3]) for r in analysis.discount_effect(lines).collect()}
    assert got == {"Not Discounted": (4.0, 2, 4.0), "Discounted": (6.0, 1, 6.0)}


def test_a_task_joins_few_megabytes(spark):
    """The sorts and hash maps of a task follow its shuffled rows, so a larger input makes more tasks, not larger ones."""
    number = "spark.sql.shuffle.partitions"
    before = spark.conf.get(number)
    spark.conf.set(number, "64")
    try:
        rows = spark.range(0, 1_500_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
        # 8 cores; some 110 MB shuffled, which the default of 64 MB a task leaves to 8 or 9 tasks.
        assert configure(spark) and rows.repartition("id").rdd.getNumPartitions() > 10
    finally:
        spark.conf.set(number, before)
