import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.functions.joins import left_join_split
from stratamart.operators import silver
from stratamart.plans.variants import BUNDLE, DECLARATIVE, NOTEBOOK, PG


@pytest.mark.parametrize("seed", range(4))
def test_split_join_equals_left_join(spark, rows, seed):
    random.seed(seed)
    key = lambda: random.choice([None, 0, 0, 0, *range(1, 12)])
    left = spark.createDataFrame([(key(), i) for i in range(60)], "k int, a int")
    right = spark.createDataFrame([(key(), i) for i in range(40)], "k int, b int")
    assert rows(left_join_split(left, right, "k")) == rows(left.join(right, "k", "left"))


def test_status_flag(spark):
    cases = [
        (True, "inactive", False), (False, "active", False), (True, "active", True), (False, "inactive", True),
        (None, "active", True), (None, "inactive", True), (True, None, True),
    ]
    df = spark.createDataFrame(cases, "is_active boolean, type_name string, expected boolean")
    flagged = df.withColumn("flag", silver.active_status_is_correct())
    assert flagged.where("flag != expected OR flag IS NULL").count() == 0


def test_full_name_treats_null_as_empty(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "f string, l string")
    assert [row[0] for row in df.select(silver.full_name("f", "l")).collect()] == ["A B", " B", "A "]


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10, 10, "2024-01-01", "completed", 5.0, None, 100.0, "Euro"),
            (2, 10, 10, "2024-01-02", None, 5.0, 1.0, 50.0, "Doubloon"),
        ],
        "order_id bigint, customer_id bigint, shipping_address_id bigint, order_date string, order_status string, "
        "subtotal double, discount_amount double, total_amount double, currency string",
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [(1, 1, 7, 2), (2, 1, 8, 0)], "order_item_id bigint, order_id bigint, product_id bigint, quantity int"
    )


def test_order_keeps_itemless_orders(spark, orders, items, rows):
    lines = silver.order(orders, items, variant=PG)
    assert rows(lines, "order_id", "product_id") == [(1, 7), (1, 8), (2, None)]


def test_order_unknown_currency_by_variant(spark, orders, items, rows):
    names = spark.createDataFrame([(7, "seven")], "product_id bigint, product_name string")
    notebook = silver.order(orders, items, product_silver=names, variant=NOTEBOOK)
    assert rows(notebook, "order_id", "product_name", "unified_amount") == [
        (1, "seven", Decimal("108.00000000")), (1, None, Decimal("108.00000000")), (2, None, None)
    ]
    payments = spark.createDataFrame(
        [(1, 10.0), (1, 30.0), (2, 50.0), (None, 9.0)], "order_id bigint, amount double"
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    paid = silver.order(orders, items, payments, variant=DECLARATIVE)
    assert rows(paid, "order_id", "product_id", "unified_amount") == [
        (1, 7, Decimal("11.00000000")), (1, 7, Decimal("33.00000000")),
        (1, 8, Decimal("11.00000000")), (1, 8, Decimal("33.00000000")),
        (2, None, Decimal("50.00000000")),
    ]
    lines = orders.join(items, "order_id")
    bundle = silver.order(lines, payments=payments.where("order_id = 2"), variant=BUNDLE)
    assert rows(bundle, "order_id", "unified_amount") == [(1, None), (1, None)]


def test_product_filters_inactive_and_unknown(spark, rows):
    product = spark.createDataFrame(
        [(1, "a", 1.0, 2.0, True, "c", "b", None), (2, "b", 1.0, 2.0, False, "c", "b", "x"),
         (3, "c", 1.0, 2.0, None, "c", "b", None), (4, "d", 1.0, 2.0, True, None, "b", None)],
        "product_id int, product_name string, price double, sell_price double, is_active boolean, "
        "product_category_id string, brand_id string, _rescued_data string",
    )
    category = spark.createDataFrame([("c", "cat")], "product_category_id string, category_name string")
    brand = spark.createDataFrame([("b", "brand")], "brand_id string, brand_name string")
    assert rows(silver.product(product, category, brand, PG), "product_id") == [(1,)]
    kept = silver.product(product, category, brand, DECLARATIVE)
    assert rows(kept, "product_id") == [(1,), (2,), (3,)]
    assert "_rescued_data" not in kept.columns
    assert silver.drop_rescued(category).columns == category.columns


def test_payment_keeps_unmatched_on_request(spark, rows):
    payment = spark.createDataFrame(
        [(1, Decimal("100.00"), 1, "pi_1", Decimal("99.50")), (2, Decimal("100.00"), None, "pi_2", Decimal("90.00")),
         (3, Decimal("100.00"), 1, None, None), (4, Decimal("100.00"), 1, "pi_4", None),
         (5, None, 1, "pi_5", Decimal("1.00"))],
        "payment_id int, amount decimal(18,2), payment_method_id int, stripe_payment_id string, stripe_amount_usd decimal(18,2)",
    )
    for name in set(silver.PAYMENT_DECLARATIVE) - set(payment.columns) - {"method_name"}:
        payment = payment.withColumn(name, F.lit(None).cast("string"))
    method = spark.createDataFrame([(1, "card")], "payment_method_id int, method_name string")
    status = ("payment_id", "payment_source", "conversion_validation_status")
    assert rows(silver.payment(payment, method), *status) == [
        (1, "Stripe", "valid"), (3, "Legacy", "N/A"), (4, "Stripe", "no_conversion_data"), (5, "Stripe", "conversion_mismatch")
    ]
    kept = silver.payment(payment, method, keep_unmatched=True)
    assert (2, "Stripe", "conversion_mismatch") in rows(kept, *status)
