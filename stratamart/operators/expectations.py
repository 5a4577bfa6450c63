"""Row-level data-quality expectations: FAIL, DROP and WARN.

A predicate that evaluates to NULL counts as a violation.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAIL, DROP, WARN = "FAIL", "DROP", "WARN"


@dataclass(frozen=True)
class Expectation:
    """``predicate`` is a SQL boolean expression over the table's columns."""

    name: str
    predicate: str
    action: str = WARN

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


class ExpectationFailed(RuntimeError):
    """At least one row violated a FAIL expectation; nothing was published."""

    def __init__(self, table: str, failed: dict[str, int]):
        self.table, self.failed = table, failed
        super().__init__(f"{table}: {', '.join(f'{name} ({count} rows)' for name, count in failed.items())}")


# Names, conditions and actions of the Silver rules, here and below.
PRODUCT_RULES = (
    Expectation("valid_product_id", "product_id IS NOT NULL", FAIL),
    Expectation("valid_cost_price", "price IS NOT NULL AND price > 0", FAIL),
    Expectation("valid_sell_price", "sell_price IS NOT NULL AND sell_price > 0", FAIL),
    Expectation("active_products_only", "is_active = true", WARN),
)
CUSTOMER_RULES = (
    Expectation("valid_customer_id", "customer_id IS NOT NULL", FAIL),
    Expectation("has_country", "country IS NOT NULL", DROP),
    Expectation("has_active_status", "is_active IS NOT NULL", DROP),
)
ORDER_RULES = (
    Expectation("valid_order_id", "order_id IS NOT NULL", FAIL),
    Expectation("valid_quantity", "quantity > 0", DROP),
)
PAYMENT_RULES = (
    Expectation("valid_payment_id", "payment_id IS NOT NULL", FAIL),
    Expectation("valid_payment_amount", "amount IS NOT NULL AND amount >= 0", FAIL),
    Expectation("stripe_status_exists", "stripe_payment_id IS NULL OR stripe_status IS NOT NULL", FAIL),
    Expectation("stripe_currency_exists", "stripe_payment_id IS NULL OR stripe_currency IS NOT NULL", DROP),
    Expectation(
        "conversion_accuracy",
        "stripe_payment_id IS NULL OR stripe_amount_usd IS NULL "
        "OR amount BETWEEN stripe_amount_usd * 0.99 AND stripe_amount_usd * 1.01",
        DROP,
    ),
)
SILVER_RULES = {
    "product_silver": PRODUCT_RULES,
    "customer_silver": CUSTOMER_RULES,
    "order_silver": ORDER_RULES,
    "payment_silver": PAYMENT_RULES,
}
# The bundle form checks fewer columns.
BUNDLE_PRODUCT_RULES = PRODUCT_RULES[:2]


def _all_hold(rules) -> Column:
    return reduce(lambda left, right: left & right, (rule.holds for rule in rules), F.lit(True))


def _dropping(rules) -> list[Expectation]:
    return [rule for rule in rules if rule.action == DROP]


def keep(df: DataFrame, rules) -> DataFrame:
    """Rows that violate no DROP rule."""
    return df.where(_all_hold(_dropping(rules)))


def apply(df: DataFrame, table: str, rules) -> tuple[DataFrame, Observation]:
    """Filtered rows plus an observation of the counts before filtering.

    One pass: the counts (``input_records``, ``dropped_records`` and the
    violations per rule) are collected by the job that writes the result and
    are available once it has run. Pass both to ``sinks.publish``, which raises
    on FAIL violations before anything becomes visible.
    """
    observation = Observation(table)
    counts = [F.count_if(~rule.holds).alias(rule.name) for rule in rules]
    dropped = F.count_if(~_all_hold(_dropping(rules))).alias("dropped_records")
    observed = df.observe(observation, F.count(F.lit(1)).alias("input_records"), dropped, *counts)
    return keep(observed, rules), observation


def failed_rules(counts: dict[str, int], rules) -> dict[str, int]:
    """FAIL rules with violations, from the observed counts."""
    return {rule.name: counts[rule.name] for rule in rules if rule.action == FAIL and counts[rule.name]}


def results(df: DataFrame, table: str, rules) -> DataFrame:
    """``(dataset, name, passed_records, failed_records)``, one row per rule, in one pass over ``df``."""
    passed = [F.count_if(rule.holds).alias(f"passed_{i}") for i, rule in enumerate(rules)]
    counted = df.agg(F.count("*").alias("total"), *passed)
    rows = F.array(*[
        F.struct(F.lit(rule.name).alias("name"), F.col(f"passed_{i}").alias("passed_records"))
        for i, rule in enumerate(rules)
    ])
    return counted.select("total", F.inline(rows)).select(
        F.lit(table).alias("dataset"),
        "name",
        "passed_records",
        (F.col("total") - F.col("passed_records")).alias("failed_records"),
    )


def violations(df: DataFrame, rules) -> DataFrame:
    """Rows violating any DROP rule, with the names of all rules they violate."""
    names = F.array_compact(F.array(*[F.when(~rule.holds, rule.name) for rule in rules]))
    return df.where(~_all_hold(_dropping(rules))).withColumn("violated_rules", names)
