from decimal import Decimal

import pytest

from stratamart.operators import expectations as expect
from stratamart.sources import sinks

BY_NAME = {rule.name: (table, rule) for table, rules in expect.SILVER_RULES.items() for rule in rules}

# rule -> (columns, passing rows, violating rows)
CASES = {
    "valid_product_id": ("product_id int", [(1,)], [(None,)]),
    "valid_cost_price": ("price double", [(0.01,)], [(0.0,), (-1.0,), (None,)]),
    "valid_sell_price": ("sell_price double", [(0.01,)], [(0.0,), (-1.0,), (None,)]),
    "active_products_only": ("is_active boolean", [(True,)], [(False,), (None,)]),
    "valid_customer_id": ("customer_id int", [(1,)], [(None,)]),
    "has_country": ("country string", [("FR",), ("",)], [(None,)]),
    "has_active_status": ("is_active boolean", [(True,), (False,)], [(None,)]),
    "valid_order_id": ("order_id int", [(1,)], [(None,)]),
    "valid_quantity": ("quantity int", [(1,)], [(0,), (-1,), (None,)]),
    "valid_payment_id": ("payment_id int", [(1,)], [(None,)]),
    "valid_payment_amount": ("amount double", [(0.0,), (5.0,)], [(-0.01,), (None,)]),
    "stripe_status_exists": (
        "stripe_payment_id string, stripe_status string", [(None, None), ("p", "ok")], [("p", None)]),
    "stripe_currency_exists": (
        "stripe_payment_id string, stripe_currency string", [(None, None), ("p", "eur")], [("p", None)]),
    "conversion_accuracy": (
        "stripe_payment_id string, amount decimal(18,2), stripe_amount_usd decimal(18,2)",
        [(None, Decimal(1), Decimal(9)), ("p", Decimal(1), None), ("p", Decimal("0.99"), Decimal(1)), ("p", Decimal("1.01"), Decimal(1))],
        [("p", Decimal("0.98"), Decimal(1)), ("p", Decimal("1.02"), Decimal(1)), ("p", None, Decimal(1))]),
}


def test_all_fourteen_rules_have_cases():
    assert set(CASES) == set(BY_NAME) and len(CASES) == 14


@pytest.mark.parametrize("name", CASES)
def test_rule(spark, name):
    columns, passing, violating = CASES[name]
    table, rule = BY_NAME[name]
    df = spark.createDataFrame([*passing, *violating], columns)
    result = expect.results(df, table, [rule]).first()
    assert tuple(result) == (table, name, len(passing), len(violating))
    kept = expect.keep(df, [rule]).count()
    assert kept == (len(passing) if rule.action == expect.DROP else len(passing) + len(violating))


def _customers(spark, *rows):
    return spark.createDataFrame(list(rows), "customer_id int, country string, is_active boolean")


def _publish(df, path):
    kept, observation = expect.apply(df, "customer_silver", expect.CUSTOMER_RULES)
    return sinks.publish(kept, observation, expect.CUSTOMER_RULES, "customer_silver", path)


def test_publish_counts_and_drops(spark, rows, tmp_path):
    df = _customers(spark, (1, "FR", True), (2, None, True), (3, "FR", None), (4, None, None))
    counts = _publish(df, str(tmp_path / "t"))
    assert counts == {
        "input_records": 4, "dropped_records": 3, "valid_customer_id": 0, "has_country": 2, "has_active_status": 2
    }
    kept = sinks.read(spark, str(tmp_path / "t"))
    assert rows(kept) == [(1, "FR", True)]
    violated = expect.violations(df, expect.CUSTOMER_RULES)
    assert kept.count() + violated.count() == df.count()
    assert violated.where("customer_id = 4").first()["violated_rules"] == ["has_country", "has_active_status"]


def test_failed_publish_keeps_previous_version(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    _publish(_customers(spark, (1, "FR", True)), path)
    with pytest.raises(expect.ExpectationFailed) as failure:
        _publish(_customers(spark, (2, "FR", True), (None, "FR", True)), path)
    assert failure.value.failed == {"valid_customer_id": 1}
    assert rows(sinks.read(spark, path)) == [(1, "FR", True)]
    _publish(_customers(spark, (3, "FR", True)), path)
    assert rows(sinks.read(spark, path)) == [(3, "FR", True)]


def test_failed_first_publish_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(expect.ExpectationFailed):
        _publish(_customers(spark, (None, None, None)), path)
    assert not (tmp_path / "t" / sinks.COMMITS).exists()


def test_create_if_absent_and_replace(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.range(1), spark.range(2)
    assert sinks.create_if_absent(one, path).count() == 1
    assert sinks.create_if_absent(two, path).count() == 1
    assert sinks.replace(two, path).count() == 2
    by_part = sinks.replace(two.selectExpr("id", "id % 2 AS part"), str(tmp_path / "p"), partition_by=["part"])
    assert rows(by_part, "id", "part") == [(0, 0), (1, 1)]


def test_warn_keeps_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, False)], "product_id int, price double, sell_price double, is_active boolean")
    kept, observation = expect.apply(df, "product_silver", expect.PRODUCT_RULES)
    assert kept.count() == 1
    assert observation.get["active_products_only"] == 1
    assert expect.failed_rules(observation.get, expect.PRODUCT_RULES) == {}
