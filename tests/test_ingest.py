import json
import random
from datetime import datetime
from decimal import Decimal

import pytest

from stratamart.operators import ingest
from stratamart.sources import payment_export

TARGET = "payment_id bigint, stripe_payment_id string"


def mapped(spark, *payments):
    raw = spark.createDataFrame(
        [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payments)], "position bigint, raw string"
    )
    return ingest.map_payments(payment_export.parse_payments(raw))


def good(id_, **other):
    return {"id": id_, "amount_received": 100, "currency": "usd", "created": 0, **other}


def statuses(spark, payments, target=()):
    classified = ingest.classify(mapped(spark, *payments), spark.createDataFrame(list(target), TARGET))
    return [row["load_status"] for row in classified.orderBy("position").collect()]


def test_mapping_and_defaults(spark):
    full, empty = mapped(
        spark,
        {"id": "pi_1", "amount_received": 2500, "currency": "EUR", "created": 86400, "status": "succeeded",
         "customer": "cus", "description": "d", "metadata": {"a": 1}},
        {"id": "pi_2"},
    ).orderBy("position").collect()
    assert (full["amount"], full["stripe_amount_usd"], full["stripe_currency"]) == (Decimal("27.00"), Decimal("27.00"), "eur")
    assert full["payment_date"] == datetime(1970, 1, 2)
    assert json.loads(full["stripe_metadata"]) == {"a": 1}
    assert (empty["stripe_amount_cents"], empty["stripe_currency"], empty["stripe_created_timestamp"]) == (0, "usd", 0)
    assert (empty["amount"], empty["stripe_metadata"], empty["stripe_status"]) == (Decimal("0.00"), "{}", None)


@pytest.mark.parametrize(
    "bad, reason",
    [
        (good("a", currency=None), "currency is null"),
        (good("a", amount_received=None), "amount_received is null or not a number"),
        (good("a", amount_received="many"), "amount_received is null or not a number"),
        (good("a", created=None), "created is null or not a number"),
        (good("a", amount_received=10_000_000_000), "numeric field overflow in stripe_amount_usd"),
        (good("a", status="s" * 51), "value too long for stripe_status (50)"),
        (good("a", currency="euro"), "value too long for stripe_currency (3)"),
        (good("i" * 256), "value too long for stripe_payment_id (255)"),
        ("[1]", "not a JSON object"),
        ("not json", "not a JSON object"),
        (good("a", created=10**13), "created is out of range"),
        (good("a", created=-(10**12)), "created is out of range"),
        (good("a", amount_received=2 * 10**18), "amount_received is out of range"),
        (good("a", amount_received=10.5), "amount_received is null or not a number"),
    ],
)
def test_quarantine(spark, bad, reason):
    rows_good, rows_bad = ingest.split_valid(mapped(spark, bad, good("b")))
    assert [row["stripe_payment_id"] for row in rows_good.collect()] == ["b"]
    assert rows_bad.first()["error_reason"] == reason


def test_first_storable_row_wins(spark):
    bad = good("a", currency=None)
    assert statuses(spark, [bad, good("a"), good("a"), bad]) == ["error", "inserted", "skipped", "skipped"]


def test_known_ids_are_skipped_even_if_bad(spark):
    assert statuses(spark, [good("a", currency=None), good("b")], [(1, "a"), (2, None)]) == ["skipped", "inserted"]


def test_rows_without_id_are_all_inserted(spark):
    payments = [good(None), good(None), good(None, currency=None), {"amount_received": 1}]
    assert statuses(spark, payments, [(1, None)]) == ["inserted", "inserted", "error", "inserted"]


def test_load_is_idempotent_and_ids_are_consecutive(spark, rows):
    target = spark.createDataFrame([(41, "x"), (7, None)], TARGET)
    payments = mapped(spark, good("b"), good("x"), good("a"), good("b"), good("c", currency=None), good("d"))
    loaded = ingest.load(payments, target).cache()
    assert rows(loaded, "payment_id", "stripe_payment_id") == [(41, "x"), (42, "b"), (43, "a"), (44, "d"), (7, None)]
    assert ingest.new_payments(payments, loaded).count() == 0
    summary = ingest.load_summary(payments, target).first().asDict()
    assert summary == {"payments_read": 6, "payments_inserted": 3, "payments_skipped": 2, "errors": 1}
    loaded.unpersist()


def test_empty_target_starts_at_one(spark, rows):
    loaded = ingest.load(mapped(spark, good("a"), good("b")), spark.createDataFrame([], TARGET))
    assert rows(loaded, "payment_id", "stripe_payment_id") == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("seed", range(3))
def test_classification_against_row_loop(spark, seed):
    """A hot id, known ids and bad rows, against a sequential reference."""
    random.seed(seed)
    pool = ["hot"] * 10 + [None, "known", "p", "q", "r"]
    payments = [good(random.choice(pool), **random.choice([{}, {}, {"currency": None}])) for _ in range(80)]
    seen, expected = {"known"}, []
    for p in payments:
        if p["id"] is not None and p["id"] in seen:
            expected.append("skipped")
        elif p["currency"] is None:
            expected.append("error")
        else:
            seen.add(p["id"])
            expected.append("inserted")
    assert statuses(spark, payments, [(1, "known")]) == expected


def test_evolve_adds_only_missing_columns(spark):
    target = spark.createDataFrame([(1, "kept")], "payment_id bigint, stripe_status string")
    evolved = ingest.evolve(target)
    assert set(ingest.STRIPE_COLUMNS) <= set(evolved.columns)
    assert evolved.first()["stripe_status"] == "kept" and evolved.first()["stripe_payment_id"] is None
    assert ingest.evolve(evolved).columns == evolved.columns


def test_rates_used(spark, rows):
    raw = spark.createDataFrame(
        [(i, json.dumps(p)) for i, p in enumerate([good("a", currency="EUR"), good("b", currency="chf"), {"id": "c"}])],
        "position bigint, raw string",
    )
    used = ingest.rates_used(payment_export.parse_payments(raw)).collect()
    assert [(r["currency"], float(r["rate"])) for r in used] == [("chf", 1.0), ("eur", 1.08), ("usd", 1.0)]
