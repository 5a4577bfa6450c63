"""Report queries over the Silver and Gold tables.

Top-N reports order by the metric and then by a key, so ties give the same
rows on every run; Spark keeps only N rows per task for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.geography import with_country_name
from stratamart.functions.ordering import RollUp
from stratamart.operators.gold import ratio


def top(df: DataFrame, metric: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest ``metric``."""
    return df.orderBy(F.desc_nulls_last(metric), *ties).limit(n)


def preview(df: DataFrame, n: int = 10, *keys: str) -> DataFrame:
    """``n`` rows: the first by ``keys``, or any without keys."""
    return (df.orderBy(*keys) if keys else df).limit(n)


# --- products -------------------------------------------------------------------


def category_quantity(product_revenue: DataFrame) -> DataFrame:
    return product_revenue.groupBy("category_name").agg(F.sum("total_quantity").alias("total_quantity"))


def bucket_small(df: DataFrame, key: str, value: str, threshold: float = 0.03, other: str = "Other") -> DataFrame:
    """Fold keys below ``threshold`` of the total into one ``other`` row.

    The total is one row, so joining it to every key is bounded.
    """
    total = df.agg(F.sum(value).alias("_total"))
    share_ok = F.col(value).cast("double") >= F.lit(threshold) * F.col("_total").cast("double")
    bucket = F.when(share_ok, F.col(key).cast("string")).otherwise(other)
    return (
        df.crossJoin(F.broadcast(total))
        .groupBy(bucket.alias(key))
        .agg(F.sum(value).alias(value))
    )


def top_products_revenue(product_revenue: DataFrame, n: int = 10, revenue: str = "related_revenue") -> DataFrame:
    return top(product_revenue.select("product_id", "product_name", revenue, "total_quantity"), revenue, n, "product_id")


def top_products_quantity(order_silver: DataFrame, n: int = 10) -> DataFrame:
    """Best-selling products by units, lines without a product name left out."""
    units = (
        order_silver.where(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(F.sum("quantity").alias("total_quantity"))
    )
    return top(units, "total_quantity", n, "product_name")


def profit_top(product_profit: DataFrame, n: int = 20) -> DataFrame:
    return top(product_profit, "total_profit", n, "product_id")


def profit_summary(product_profit: DataFrame, n: int | None = 20) -> DataFrame:
    """Products, profit, mean margin and best product, over the top ``n`` (None: over all)."""
    rows = product_profit if n is None else profit_top(product_profit, n)
    best = F.max_by("product_name", F.struct("total_profit", (-F.col("product_id")).alias("tie")))
    return rows.agg(
        F.count("*").alias("products_analyzed"),
        F.sum("total_profit").alias("total_profit"),
        F.avg("profit_margin").alias("avg_profit_margin"),
        best.alias("top_product"),
    )


def profit_distribution(product_profit: DataFrame) -> DataFrame:
    return product_profit.select("product_id", "product_name", "total_quantity", "total_profit", "profit_margin")


# --- orders and customers -------------------------------------------------------


def order_quantity_distribution(order_silver: DataFrame) -> DataFrame:
    """Distinct orders per line quantity."""
    return order_silver.groupBy("quantity").agg(F.count_distinct("order_id").alias("order_count"))


def discount_effect(order_silver: DataFrame) -> DataFrame:
    """Amounts and orders with and without discount; the average is per order line."""
    discount = F.col("discount_amount")
    status = F.when(discount.isNull() | (discount == 0), "Not Discounted").otherwise("Discounted")
    return order_silver.groupBy(status.alias("discounted_status")).agg(
        F.sum("unified_amount").alias("total_unified_amount"),
        F.count_distinct("order_id").alias("total_orders"),
        ratio(F.sum("unified_amount"), F.count("unified_amount")).alias("avg_unified_amount_per_order"),
    )


def customer_order_frequency(order_silver: DataFrame) -> DataFrame:
    """Distinct orders per customer."""
    return order_silver.groupBy("customer_id").agg(F.count_distinct("order_id").alias("order_count"))


def customer_order_frequency_histogram(order_silver: DataFrame) -> DataFrame:
    """Customers per number of orders."""
    return customer_order_frequency(order_silver).groupBy("order_count").agg(F.count("*").alias("customers"))


def order_status_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("total_amount")
    )


def payment_trend(payments: DataFrame, grain: str = "month") -> DataFrame:
    return payments.groupBy(F.date_trunc(grain, "payment_date").cast("date").alias("period")).agg(
        F.count("*").alias("payment_count"), F.sum("amount").alias("total_amount")
    )


# --- cancellations --------------------------------------------------------------


def with_support(cancelled_product: DataFrame, min_orders: int = 5) -> DataFrame:
    """Products with enough lines of known status, with that count as ``total_orders``."""
    counted = F.col("cancelled_count") + F.col("non_cancelled_count")
    return cancelled_product.withColumn("total_orders", counted).where(F.col("total_orders") >= min_orders)


def cancellation_top(cancelled_product: DataFrame, n: int = 10, min_orders: int = 5) -> DataFrame:
    return top(with_support(cancelled_product, min_orders), "return_rate", n, "product_id")


def cancellation_summary(cancelled_product: DataFrame, min_orders: int = 5, high: float = 0.2) -> DataFrame:
    """Mean and exact median rate, and how many products exceed ``high``; from one roll-up of the rates."""
    # Rates as integers in units of 1e-12: distinct rates of realistic counts stay distinct.
    scaled = F.round(F.col("return_rate") * 1e12)
    rolled = RollUp(with_support(cancelled_product, min_orders).select("return_rate"), [], "return_rate", scaled)
    rate, n = F.col("return_rate"), F.col("_n")
    stats = rolled.counts.agg(
        F.try_divide(F.sum(rate * n), F.sum(F.when(rate.isNotNull(), n))).alias("avg_return_rate"),
        F.coalesce(F.sum(F.when(rate > high, n)), F.lit(0)).alias("high_rate_products"),
    )
    median = rolled.percentile(0.5, "median_return_rate", F.lit(1e-12))
    return stats.join(F.broadcast(median), F.lit(True), "left")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal widths over [min, max]; the last bin is closed, empty bins are listed.

    A constant column is spread over [value - 0.5, value + 0.5].
    """
    span = df.agg(F.min(value).alias("_min"), F.max(value).alias("_max")).where(F.col("_min").isNotNull())
    constant = F.col("_min") == F.col("_max")
    span = span.select(
        F.when(constant, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_low"),
        F.when(constant, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_high"),
    )
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.least(F.floor((F.col(value) - F.col("_low")) / width), F.lit(bins - 1)).cast("int")
    counts = (
        df.where(F.col(value).isNotNull())
        .crossJoin(F.broadcast(span))
        .groupBy(place.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edges = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"),
    )
    return edges.join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("product_count")
    )


def cancellation_histogram(cancelled_product: DataFrame, bins: int = 20, min_orders: int = 5) -> DataFrame:
    """Distribution of the cancellation rate in percent."""
    rates = with_support(cancelled_product, min_orders).select((F.col("return_rate") * 100).alias("rate_pct"))
    return histogram(rates, "rate_pct", bins)


# --- geography ------------------------------------------------------------------


def country_sales_named(sales_country: DataFrame, n: int | None = None) -> DataFrame:
    """Country sales with display names, known countries only; optionally the top ``n``."""
    named = with_country_name(sales_country).where(F.col("country_name").isNotNull())
    named = named.select("country", "country_name", "total_sales", "order_count", "customer_count")
    return named if n is None else top(named, "total_sales", n, "country")


def region_ranking(sales_region: DataFrame) -> DataFrame:
    return sales_region.orderBy(F.desc("total_sales"), "region")


def _two_places(column: Column) -> Column:
    return F.round(column, 2)


def region_aov(sales_region: DataFrame) -> DataFrame:
    """Average order value per region."""
    return sales_region.select(
        "region",
        "total_sales",
        "order_count",
        _two_places(ratio(F.col("total_sales"), F.col("order_count"))).alias("avg_order_value"),
    )


def region_summary(sales_region: DataFrame) -> DataFrame:
    return sales_region.agg(
        F.count("*").alias("total_regions"),
        F.sum("total_sales").alias("total_sales"),
        F.min_by("region", F.struct((-F.col("total_sales")).alias("least"), "region")).alias("top_region"),
        F.max("total_sales").alias("top_region_sales"),
    )


def region_share(sales_region: DataFrame) -> DataFrame:
    """Each region's percentage of all sales."""
    total = sales_region.agg(F.sum("total_sales").alias("_total"))
    share = ratio(F.col("total_sales"), F.col("_total")) * 100
    return sales_region.crossJoin(F.broadcast(total)).select(
        "region", "total_sales", _two_places(share).alias("share_pct")
    )
