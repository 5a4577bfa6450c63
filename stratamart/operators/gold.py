"""Gold tables.

Every product table first reduces order lines per product (partial aggregation
runs before the shuffle, so a product with a third of all lines is collapsed
map-side) and joins the reduced rows to the products, instead of joining line
by line. Re-aggregating after the join keeps the result equal to the plain
join-then-group form even when a dimension holds duplicate keys.

Sums over order lines repeat an order's amount once per line; this is the
defined meaning of the reference-exact tables. ``*_allocated``,
``*_order_grain`` and ``*_orders`` are the forms without that inflation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.geography import map_region
from stratamart.functions.ordering import RollUp
from stratamart.plans.variants import DECLARATIVE, NOTEBOOK, PG, Variant

CANCELLED = "cancelled"


def non_cancelled(df: DataFrame, status: str = "order_status") -> DataFrame:
    """Rows whose status is known and not cancelled (NULL status is dropped)."""
    return df.where(F.col(status) != CANCELLED)


def _exact(column: Column) -> Column:
    """A per-key partial sum narrowed so that later products and sums stay exact."""
    return column.cast("decimal(28,8)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


# --- product revenue and profit -------------------------------------------------


def lines_per_product(order_silver: DataFrame, amount: str, distinct_orders: bool = False) -> DataFrame:
    """``(product_id, quantity, amount[, orders])`` from order lines."""
    measures = [F.sum("quantity").alias("quantity"), F.sum(amount).alias("amount")]
    if distinct_orders:
        measures.append(F.count_distinct("order_id").alias("orders"))
    return order_silver.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(*measures)


def product_revenue(product_silver: DataFrame, order_silver: DataFrame, variant: Variant = PG) -> DataFrame:
    """``product_revenue_gold``: quantity, cost and order amount per product, non-cancelled orders."""
    reduced = lines_per_product(non_cancelled(order_silver), variant.sales_amount, distinct_orders=variant == PG)
    return finish_product_revenue(product_silver, reduced, variant)


def finish_product_revenue(product_silver: DataFrame, per_product: DataFrame, variant: Variant) -> DataFrame:
    keys = ["product_id", "product_name", "category_name", "price"]
    grouped = product_silver.select(*keys).join(per_product, "product_id").groupBy(*keys)
    quantity, revenue = F.sum("quantity"), F.sum(_exact(F.col("amount")))
    cost = quantity * F.col("price")
    if variant == PG:
        zero = F.lit(0)
        return grouped.agg(
            F.max("orders").alias("total_orders"),
            F.coalesce(quantity, zero).alias("total_quantity"),
            F.coalesce(cost, zero).alias("total_cost"),
            F.coalesce(revenue, zero).alias("total_revenue"),
        )
    return grouped.agg(
        quantity.alias("total_quantity"), cost.alias("total_cost"), revenue.alias("related_revenue")
    )


def product_revenue_allocated(
    product_silver: DataFrame, order_silver: DataFrame, amount: str = "unified_amount"
) -> DataFrame:
    """Order amounts split over the order's lines by quantity x price.

    Revenue adds up to the true total of all non-cancelled orders that have a
    kept line of non-zero weight. Weights are summed per order and joined back,
    so an order with very many lines needs no window over its lines.
    """
    lines = (
        non_cancelled(order_silver)
        .select("order_id", "product_id", "quantity", F.col(amount).alias("amount"))
        .join(product_silver.select("product_id", "product_name", "category_name", "price"), "product_id")
        .withColumn("weight", F.col("quantity") * F.col("price"))
    )
    orders = lines.groupBy("order_id").agg(F.sum("weight").alias("order_weight"))
    share = ratio(F.col("weight"), F.col("order_weight"))
    keys = ["product_id", "product_name", "category_name", "price"]
    return (
        lines.join(orders, "order_id")
        .groupBy(*keys)
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("weight").alias("total_cost"),
            F.sum(F.col("amount").cast("double") * share).alias("allocated_revenue"),
        )
    )


def product_profit(product_silver: DataFrame, order_silver: DataFrame, variant: Variant = DECLARATIVE) -> DataFrame:
    """``product_profit_gold``: declarative by sell price, bundle by amounts received.

    The bundle form counts cancelled orders too.
    """
    lines = non_cancelled(order_silver) if variant == DECLARATIVE else order_silver
    return finish_product_profit(product_silver, lines_per_product(lines, "unified_amount"), variant)


def finish_product_profit(product_silver: DataFrame, per_product: DataFrame, variant: Variant) -> DataFrame:
    keys = ["product_id", "product_name", "category_name", "price"]
    if variant == DECLARATIVE:
        keys.append("sell_price")
    totals = (
        product_silver.select(*keys)
        .join(per_product, "product_id")
        .groupBy(*keys)
        .agg(
            F.sum(_exact(F.col("amount"))).alias("total_payment_amount"),
            F.sum("quantity").alias("total_quantity"),
        )
    )
    quantity = F.col("total_quantity")
    cost = F.col("price") * quantity
    if variant == DECLARATIVE:
        sold = F.col("sell_price") * quantity
        profit = sold - cost
        return totals.select(
            *keys[:4], "total_payment_amount", "total_quantity",
            cost.alias("total_cost"),
            profit.alias("total_profit"),
            ratio(profit, quantity).alias("unit_profit"),
            ratio(profit, sold).alias("profit_margin"),
        )
    # Narrowed operands keep all eight decimals of the difference.
    profit = _exact(F.col("total_payment_amount")) - cost.cast("decimal(28,2)")
    return totals.select(
        *keys[:3], "total_payment_amount", "total_quantity",
        cost.alias("total_cost"),
        profit.alias("total_profit"),
        ratio(profit, F.col("total_payment_amount")).alias("profit_margin"),
    )


# --- cancellations --------------------------------------------------------------


def _status_counts(order_silver: DataFrame) -> DataFrame:
    status = F.col("order_status")
    return order_silver.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count_if(status == CANCELLED).alias("cancelled"),
        F.count_if(status != CANCELLED).alias("kept"),
        F.count("*").alias("lines"),
    )


def cancelled_product(product_silver: DataFrame, order_silver: DataFrame) -> DataFrame:
    """``cancelled_product_gold`` at line grain; a NULL status counts in the rate's denominator only."""
    return finish_cancelled_product(product_silver, _status_counts(order_silver))


def finish_cancelled_product(product_silver: DataFrame, per_product: DataFrame) -> DataFrame:
    return (
        product_silver.select("product_id", "product_name")
        .join(per_product, "product_id")
        .groupBy("product_id", "product_name")
        .agg(
            F.sum("cancelled").alias("cancelled_count"),
            F.sum("kept").alias("non_cancelled_count"),
            ratio(F.sum("cancelled"), F.sum("lines")).alias("return_rate"),
        )
    )


def cancelled_product_orders(product_silver: DataFrame, order_silver: DataFrame) -> DataFrame:
    """Cancellation counts over distinct orders instead of lines."""
    orders = (
        order_silver.where(F.col("product_id").isNotNull())
        .select("product_id", "order_id", "order_status")
        .distinct()
    )
    per_product = _status_counts(orders)
    return (
        product_silver.select("product_id", "product_name")
        .distinct()
        .join(per_product, "product_id")
        .select(
            "product_id",
            "product_name",
            F.col("cancelled").alias("cancelled_count"),
            F.col("kept").alias("non_cancelled_count"),
            ratio(F.col("cancelled"), F.col("lines")).alias("return_rate"),
        )
    )


# --- sales by geography ---------------------------------------------------------


def order_totals(order_silver: DataFrame, variant: Variant = DECLARATIVE) -> DataFrame:
    """``(order_id, customer_id, amount)``: line-grain amounts summed per non-cancelled order."""
    return (
        non_cancelled(order_silver)
        .groupBy("order_id", "customer_id")
        .agg(F.sum(variant.sales_amount).alias("amount"))
    )


def sales_by(totals: DataFrame, customers: DataFrame, place: str, keyed: bool = False) -> DataFrame:
    """Sales, orders and customers per ``place`` from order totals.

    ``customers`` has ``customer_id`` and ``place``, with one row per address.
    Customer rows are counted per (customer, place) before the join, so the
    fan-out over addresses becomes a multiplication.

    With ``keyed`` the caller states that an order id belongs to one customer
    (``latest_by_key`` restores that for change feeds). Orders are then counted
    per customer on the join's own partitioning and no distinct count over all
    order ids has to be shuffled.
    """
    parts = customers.groupBy("customer_id", place).agg(F.count("*").cast("decimal(9,0)").alias("_addresses"))
    sold = totals.join(parts, "customer_id").withColumn("_sales", _exact(F.col("amount")) * F.col("_addresses"))
    if not keyed:
        return sold.groupBy(place).agg(
            F.sum("_sales").alias("total_sales"),
            F.count_distinct("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("customer_count"),
        )
    per_customer = sold.groupBy("customer_id", place).agg(
        F.sum("_sales").alias("_sales"), F.count("*").alias("_orders")
    )
    return per_customer.groupBy(place).agg(
        F.sum("_sales").alias("total_sales"),
        F.sum("_orders").alias("order_count"),
        F.count("*").alias("customer_count"),
    )


def _customer_regions(customer_silver: DataFrame, variant: Variant) -> DataFrame:
    region = map_region(F.col("country"), variant.region_map, variant.region_otherwise)
    return customer_silver.select("customer_id", region.alias("region"))


def sales_region_from_totals(
    totals: DataFrame, customer_silver: DataFrame, variant: Variant = DECLARATIVE, keyed: bool = False
) -> DataFrame:
    return sales_by(totals, _customer_regions(customer_silver, variant), "region", keyed)


def sales_country_from_totals(totals: DataFrame, customer_silver: DataFrame, keyed: bool = False) -> DataFrame:
    return sales_by(totals, customer_silver.select("customer_id", "country"), "country", keyed)


def sales_region(order_silver: DataFrame, customer_silver: DataFrame, variant: Variant = DECLARATIVE) -> DataFrame:
    """``sales_region_gold`` from the Silver tables."""
    return sales_region_from_totals(order_totals(order_silver, variant), customer_silver, variant)


def sales_country(order_silver: DataFrame, customer_silver: DataFrame, variant: Variant = DECLARATIVE) -> DataFrame:
    """``sales_country_gold`` from the Silver tables."""
    return sales_country_from_totals(order_totals(order_silver, variant), customer_silver)


def order_grain_sales(orders: DataFrame, customer_silver: DataFrame, variant: Variant = PG) -> DataFrame:
    """One row per non-cancelled order with its customer's country (the smallest) and region."""
    homes = customer_silver.groupBy("customer_id").agg(F.min("country").alias("country"))
    region = map_region(F.col("country"), variant.region_map, variant.region_otherwise)
    return (
        non_cancelled(orders)
        .select("order_id", "customer_id", "total_amount")
        .join(homes, "customer_id")
        .withColumn("region", region)
    )


def sales_region_order_grain(orders: DataFrame, customer_silver: DataFrame, variant: Variant = PG) -> DataFrame:
    """Regional sales without inflation: every order counts once, in one region."""
    sold = order_grain_sales(orders, customer_silver, variant)
    per_customer = sold.groupBy("customer_id", "region").agg(
        F.sum("total_amount").alias("_sales"), F.count("*").alias("_orders")
    )
    return per_customer.groupBy("region").agg(
        F.sum("_sales").alias("total_sales"),
        F.sum("_orders").alias("order_count"),
        F.count("*").alias("customer_count"),
    )


# --- payments -------------------------------------------------------------------


def stripe_payment(payment_silver: DataFrame) -> DataFrame:
    """``stripe_payment_gold``: external payments by status and currency."""
    usd = F.col("stripe_amount_usd")
    positive = F.when(usd > 0, usd)
    return (
        payment_silver.where(F.col("payment_source") == "Stripe")
        .groupBy("stripe_status", "stripe_currency")
        .agg(
            F.count("*").alias("payment_count"),
            F.coalesce(F.sum(positive), F.lit(0)).alias("total_amount_usd"),
            F.avg(positive.cast("double")).alias("avg_amount_usd"),
            F.min("stripe_created_timestamp").alias("earliest_payment"),
            F.max("stripe_created_timestamp").alias("latest_payment"),
            F.count_if(F.col("conversion_validation_status") == "valid").alias("conversion_validated_count"),
        )
        .select(
            F.coalesce("stripe_status", F.lit("N/A")).alias("payment_status"),
            F.coalesce("stripe_currency", F.lit("N/A")).alias("currency"),
            "payment_count", "total_amount_usd", "avg_amount_usd",
            "earliest_payment", "latest_payment", "conversion_validated_count",
        )
    )


def payment_source(payment_silver: DataFrame) -> DataFrame:
    """``payment_source_gold``: count, sum, spread and exact median per source.

    The payments are read once and rolled up to counts per source and amount,
    from which all columns come; no source's amounts are gathered in one task.
    """
    cents = (F.col("amount") * 100).cast("bigint")
    rolled = RollUp(payment_silver.select("payment_source", "amount"), ["payment_source"], "amount", cents)
    stats = rolled.statistics()
    medians = rolled.percentile(0.5, "median_amount", F.lit(0.01)).withColumnRenamed("payment_source", "_source")
    return stats.join(medians, F.col("payment_source") == F.col("_source"), "left").select(
        "payment_source", F.col("rows").alias("total_payments"), F.col("total").cast("decimal(28,2)").alias("total_amount"),
        F.col("mean").alias("avg_amount"), F.col("least").alias("min_amount"), F.col("greatest").alias("max_amount"),
        F.col("deviation").alias("stddev_amount"), "median_amount",
    )


def currency_distribution(payments: DataFrame) -> DataFrame:
    """``currency_distribution_gold``: amounts and conversion accuracy per payment currency.

    Grouping is on the stored currency, so NULL is the single 'Legacy' row.
    Pass payments after the expectations, or the unfiltered Silver table to see
    mismatches that the expectations would have dropped.
    """
    status = F.col("conversion_validation_status")
    valid = F.count_if(status == "valid")
    return (
        payments.groupBy("stripe_currency")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").alias("total_usd_amount"),
            F.avg(F.col("amount").cast("double")).alias("avg_usd_amount"),
            valid.alias("conversion_validated_count"),
            F.count_if(status == "conversion_mismatch").alias("conversion_mismatch_count"),
            (ratio(valid, F.count("*")) * 100).alias("conversion_accuracy_pct"),
        )
        .select(
            F.coalesce("stripe_currency", F.lit("Legacy")).alias("currency"),
            "transaction_count", "total_usd_amount", "avg_usd_amount",
            "conversion_validated_count", "conversion_mismatch_count", "conversion_accuracy_pct",
        )
    )
