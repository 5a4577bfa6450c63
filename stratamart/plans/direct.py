"""Gold tables straight from Bronze, with aggregation moved below the joins.

The Silver order table repeats an order once per line (and per payment). Sums
over it only need how often each order repeats, so these plans count lines and
add up payments per order first (collapsing map-side) and join one row per
order. Results equal the Silver-based Gold tables; use those when Silver is
materialised anyway, and these when only Gold is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions import fx
from stratamart.operators import expectations as expect
from stratamart.operators import gold
from stratamart.plans.variants import DECLARATIVE, PG, Variant

REPEAT_TYPE = "decimal(9,0)"


def _payments_per_order(orders: DataFrame, payments: DataFrame, variant: Variant) -> DataFrame:
    """Orders with ``unified_amount`` over all payments and ``payment_rows`` (1 when unpaid)."""
    # Each payment is converted and rounded by itself, as in the Silver table; equal
    # amounts of an order are still counted before the shuffle.
    paid = payments.groupBy("order_id", F.col("amount").alias("paid")).agg(F.count("*").alias("times"))
    joined = fx.convert(orders.join(paid, "order_id", "left"), "paid", "currency", variant.book)
    times = F.coalesce("times", F.lit(1))
    return joined.groupBy(*orders.columns).agg(
        F.sum(F.col("unified_amount") * times.cast(REPEAT_TYPE)).cast(fx.UNIFIED_TYPE).alias("unified_amount"), F.sum(times).alias("payment_rows")
    )


def order_totals(
    orders: DataFrame, items: DataFrame, payments: DataFrame | None = None, variant: Variant = DECLARATIVE
) -> DataFrame:
    """Per non-cancelled order, what its Silver lines add up to."""
    kept = gold.non_cancelled(orders).select("order_id", "customer_id", "currency", "total_amount")
    if variant == DECLARATIVE:
        lines = expect.keep(items, expect.ORDER_RULES).groupBy("order_id").agg(F.count("*").alias("lines"))
        repeated = _payments_per_order(kept, payments, variant).join(lines, "order_id")
    else:
        lines = items.groupBy("order_id").agg(F.count("*").alias("lines"))
        repeated = kept.join(lines, "order_id", "left").withColumn("lines", F.coalesce("lines", F.lit(1)))
        if variant.book is not None:
            repeated = fx.convert(repeated, "total_amount", "currency", variant.book)
    amount = F.col(variant.sales_amount) * F.col("lines").cast(REPEAT_TYPE)
    return repeated.select("order_id", "customer_id", amount.alias("amount"))


def lines_per_product(
    orders: DataFrame, items: DataFrame, payments: DataFrame | None = None, variant: Variant = DECLARATIVE
) -> DataFrame:
    """``(product_id, quantity, amount[, orders])`` over non-cancelled orders."""
    kept = gold.non_cancelled(orders).select("order_id", "currency", "total_amount")
    if variant == DECLARATIVE:
        priced = _payments_per_order(kept, payments, variant)
        lines = expect.keep(items, expect.ORDER_RULES).join(priced, "order_id")
        lines = lines.withColumn("quantity", F.col("quantity") * F.col("payment_rows"))
    else:
        priced = kept if variant.book is None else fx.convert(kept, "total_amount", "currency", variant.book)
        lines = items.join(priced, "order_id")
    return gold.lines_per_product(lines, variant.sales_amount, distinct_orders=variant == PG)
