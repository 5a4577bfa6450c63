"""Data-quality metrics and the check suite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.literals import literal_rows
from stratamart.operators.gold import order_grain_sales, ratio
from stratamart.plans.variants import PG, Variant

PASSED, FAILED = "PASSED", "FAILED"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def percent(part: Column, total: Column) -> Column:
    """Percentage, zero for an empty total."""
    return F.coalesce(ratio(part, total) * 100, F.lit(0.0))


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` of several tables in one job."""
    return _union(
        [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
         for name, df in tables.items()]
    )


def stripe_loaded_count(payment: DataFrame) -> DataFrame:
    return payment.agg(F.count("stripe_payment_id").alias("stripe_payments_loaded"))


def country_coverage(sales_country: DataFrame, count_null: bool = False) -> DataFrame:
    """Distinct countries, sorted; optionally the NULL country as one of them."""
    rows = sales_country if count_null else sales_country.where(F.col("country").isNotNull())
    return rows.select("country").distinct().orderBy("country")


def country_count(sales_country: DataFrame, count_null: bool = False) -> DataFrame:
    return country_coverage(sales_country, count_null).agg(F.count("*").alias("total_countries"))


def date_range(orders: DataFrame) -> DataFrame:
    """First and last order date and the days between them."""
    return orders.agg(
        F.min("order_date").alias("oldest_order_date"),
        F.max("order_date").alias("newest_order_date"),
        F.date_diff(F.max("order_date"), F.min("order_date")).alias("days_span"),
    )


def missing_country(customer_silver: DataFrame, blank_counts: bool = True) -> DataFrame:
    """Customer rows without country; ``blank_counts`` treats '' as missing too."""
    country = F.col("country")
    missing = country.isNull() | (country == "") if blank_counts else country.isNull()
    return customer_silver.agg(
        F.count_if(missing).alias("missing_country"),
        F.count("*").alias("total_customers"),
        percent(F.count_if(missing), F.count("*")).alias("missing_pct"),
    )


def status_conflicts(customer_silver: DataFrame) -> DataFrame:
    """Customer rows whose active flag contradicts their type."""
    conflict = F.count_if(~F.col("active_status_is_correct"))
    return customer_silver.agg(
        conflict.alias("flagged_customers"),
        F.round(percent(conflict, F.count("*")), 2).alias("pct"),
    )


def unattributed_sales(orders: DataFrame, customer_silver: DataFrame, variant: Variant = PG) -> DataFrame:
    """Orders and amount whose customer has no country, with their shares."""
    sold = order_grain_sales(orders, customer_silver, variant)
    nowhere = F.col("country").isNull()
    lost = F.sum(F.when(nowhere, F.col("total_amount")))
    return sold.agg(
        F.count_if(nowhere).alias("unattributed_orders"),
        lost.alias("unattributed_amount"),
        percent(F.count_if(nowhere), F.count("*")).alias("order_pct"),
        percent(lost, F.sum("total_amount")).alias("amount_pct"),
    )


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def non_positive_count(column: str) -> Column:
    return F.count_if(F.col(column) <= 0)


def run_checks(df: DataFrame, checks: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """``(test, status, message)``: each check is a violation count that must be zero.

    All counts come from one aggregation over ``df``. ``checks`` maps the test
    name to the count and a description of what was counted.
    """
    names = list(checks)
    counted = df.agg(*[checks[name][0].alias(f"check_{i}") for i, name in enumerate(names)])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("test"),
            F.col(f"check_{i}").alias("violations"),
            F.lit(checks[name][1]).alias("what"),
        )
        for i, name in enumerate(names)
    ])
    failed = F.col("violations") > 0
    return counted.select(F.inline(rows)).select(
        "test",
        F.when(failed, FAILED).otherwise(PASSED).alias("status"),
        F.when(failed, F.concat(F.lit("Found "), F.col("violations").cast("string"), F.lit(" "), F.col("what")))
        .otherwise("")
        .alias("message"),
    )


def schema_contract(df: DataFrame, test: str, required: Sequence[str]) -> DataFrame:
    """One result row per required column, from the schema alone."""
    rows = [
        (f"{test}: {name}", PASSED if name in df.columns else FAILED,
         "" if name in df.columns else f"Column {name} not found")
        for name in required
    ]
    return literal_rows(df.sparkSession, ("test", "status", "message"), rows)


def product_checks(product: DataFrame) -> DataFrame:
    """The product suite: required columns, no NULL ids, positive prices."""
    contract = schema_contract(product, "product_schema", ("product_id", "product_name", "price"))
    data = run_checks(
        product,
        {
            "no_null_product_ids": (null_count("product_id"), "null values in product_id"),
            "all_prices_are_positive": (non_positive_count("price"), "products with non-positive prices"),
        },
    )
    return contract.unionByName(data)


def freshness(df: DataFrame, timestamp: str, max_age_minutes: int, as_of: Column) -> DataFrame:
    """Age of the newest row at ``as_of`` and whether it is within the limit; an empty table is stale."""
    newest = df.agg(F.max(timestamp).alias("newest"))
    age = F.timestamp_diff("MINUTE", F.col("newest"), as_of)
    return newest.select(
        "newest",
        age.alias("age_minutes"),
        F.coalesce(age <= max_age_minutes, F.lit(False)).alias("is_fresh"),
    )
