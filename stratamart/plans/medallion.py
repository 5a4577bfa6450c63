"""One run over all layers: Bronze in, published Silver and Gold out, run log appended."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart.operators import expectations as expect
from stratamart.operators import gold, monitor, quality, silver
from stratamart.plans.variants import BUNDLE, DECLARATIVE, NOTEBOOK, Variant
from stratamart.sources import sinks


def silver_builders(
    bronze: Mapping[str, DataFrame], published: Mapping[str, DataFrame], variant: Variant = DECLARATIVE
) -> dict[str, Callable[[], DataFrame]]:
    """Silver tables before their expectations, by name; a later one may read those published before it."""
    payments = bronze["payment_postgres"]
    if variant == BUNDLE:
        # The bundle form's products carry their names and its orders are at line grain.
        return {
            "product_silver": lambda: silver.product(bronze["product"], variant=BUNDLE),
            "order_silver": lambda: silver.order(bronze["orders"], payments=payments, variant=BUNDLE),
        }
    named = (lambda: published["product_silver"]) if variant == NOTEBOOK else (lambda: None)
    paid = payments if variant == DECLARATIVE else None
    return {
        "product_silver": lambda: silver.product(bronze["product"], bronze["product_category"], bronze["brand"], variant),
        "customer_silver": lambda: silver.customer(bronze["customer"], bronze["customer_type"], bronze["address"], variant),
        "order_silver": lambda: silver.order(bronze["orders"], bronze["order_item"], paid, named(), variant),
        "payment_silver": lambda: silver.payment(payments, bronze["payment_method"], variant),
    }


def silver_rules(variant: Variant) -> dict[str, Sequence[expect.Expectation]]:
    """The expectations each form enforces; pg and notebook have none."""
    if variant == DECLARATIVE:
        return expect.SILVER_RULES
    if variant == BUNDLE:
        return {"product_silver": expect.BUNDLE_PRODUCT_RULES, "order_silver": expect.ORDER_RULES}
    return {}


def gold_builders(tables: Mapping[str, DataFrame], variant: Variant = DECLARATIVE) -> dict[str, Callable[[], DataFrame]]:
    """Gold tables over the published Silver tables, by name."""
    products, orders = tables["product_silver"], tables["order_silver"]
    if variant == BUNDLE:
        return {"product_profit_gold": lambda: gold.product_profit(products, orders, BUNDLE)}
    customers, payments = tables["customer_silver"], tables["payment_silver"]
    sales = {
        "sales_region_gold": lambda: gold.sales_region(orders, customers, variant),
        "sales_country_gold": lambda: gold.sales_country(orders, customers, variant),
    }
    if variant != DECLARATIVE:
        return {
            "product_revenue_gold": lambda: gold.product_revenue(products, orders, variant),
            "cancelled_product_gold": lambda: gold.cancelled_product(products, orders),
            **sales,
        }
    return {
        "product_profit_gold": lambda: gold.product_profit(products, orders, DECLARATIVE),
        "cancelled_product_gold": lambda: gold.cancelled_product(products, orders),
        **sales,
        "stripe_payment_gold": lambda: gold.stripe_payment(payments),
        "payment_source_gold": lambda: gold.payment_source(payments),
        "currency_distribution_gold": lambda: gold.currency_distribution(payments),
    }


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    out: str,
    log_path: str,
    cause: str = "SCHEDULE",
    update_id: str | None = None,
    variant: Variant = DECLARATIVE,
) -> dict[str, DataFrame]:
    """Build and publish every Silver and Gold table under ``out``; returns them as published.

    Each Silver table is written once and read back, so Gold never recomputes
    it and a lost executor costs at most the stage at hand. When a FAIL
    expectation is violated the run stops with the earlier versions in place
    and is logged as FAILED. A run that succeeds removes what earlier runs left over.
    """
    update_id = update_id or uuid.uuid4().hex
    started = _now()
    flows: dict[str, tuple[int, dict[str, tuple[int, int]]]] = {}
    published: dict[str, DataFrame] = {}
    state, error = "COMPLETED", None
    try:
        counts = quality.table_row_counts({f"{name}_bronze": df for name, df in bronze.items()}).collect()
        flows.update({row["table_name"]: (row["row_count"], {}) for row in counts})
        for name, build in silver_builders(bronze, published, variant).items():
            rules = silver_rules(variant).get(name, ())
            kept, observation = expect.apply(build(), name, rules)
            seen = sinks.publish(kept, observation, rules, name, f"{out}/{name}")
            total = seen["input_records"]
            results = {rule.name: (total - seen[rule.name], seen[rule.name]) for rule in rules}
            flows[name] = (total - seen["dropped_records"], results)
            published[name] = sinks.read(spark, f"{out}/{name}")
        for name, build in gold_builders(published, variant).items():
            observation = Observation(name)
            rows = build().observe(observation, F.count(F.lit(1)).alias("records"))
            published[name] = sinks.replace(rows, f"{out}/{name}")
            flows[name] = (observation.get["records"], {})
    except Exception as failure:
        state, error = "FAILED", str(failure)
        raise
    finally:
        entries = monitor.run_entries(spark, update_id, started, _now(), state, cause, error, flows)
        monitor.record_run(entries, log_path)
    for name in published:
        sinks.collect_garbage(spark, f"{out}/{name}")
    return published
