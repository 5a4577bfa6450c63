import json

import pytest
from pyspark.sql import functions as F

from stratamart.operators import ingest
from stratamart.operators.quarantine import Quarantine
from stratamart.sources import payment_export, sinks


def mapped(spark, *payments):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payments)]
    return ingest.map_payments(payment_export.parse_payments(spark.createDataFrame(rows, "position bigint, raw string")))


def good(id_, **other):
    return {"id": id_, "amount_received": 100, "currency": "usd", "created": 0, **other}


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/payments"
    sinks.replace(spark.createDataFrame([(7, "known")], "payment_id bigint, stripe_payment_id string"), path)
    return path


def ids(df):
    return sorted((row["payment_id"], row["stripe_payment_id"]) for row in df.collect())


def repairs(spark, quarantine, table, change):
    rows = [(row["content_key"], change(row["raw"])) for row in quarantine.open(table).collect()]
    return spark.createDataFrame(rows, "content_key string, raw string")


def test_bad_records_are_kept_once_and_replayed_once(spark, tmp_path, table):
    quarantine = Quarantine(spark, f"{tmp_path}/quarantine")
    assert quarantine.open(table).count() == 0
    batch = mapped(spark, good("a", currency=None), good("b"), good(None, created=None), "not json", good("a", currency=None), good("known"))
    assert ids(quarantine.load(batch, table)) == [(7, "known"), (8, "b")]
    quarantine.load(batch, table)
    assert sorted(r["error_reason"] for r in quarantine.entries().collect()) == ["created is null or not a number", "currency is null", "not a JSON object"]
    fix = repairs(spark, quarantine, table, lambda raw: raw.replace("null, \"created\"", "\"usd\", \"created\"").replace('"created": null', '"created": 5'))
    loaded = quarantine.replay(fix, table)
    assert ids(loaded) == [(7, "known"), (8, "b"), (9, "a"), (10, None)]
    assert ids(quarantine.replay(fix, table)) == ids(loaded)
    assert [r["raw"] for r in quarantine.open(table).collect()] == ["not json"]


def test_entries_of_later_batches_come_behind(spark, tmp_path, table):
    quarantine = Quarantine(spark, f"{tmp_path}/quarantine")
    quarantine.load(mapped(spark, good("y"), good("z", currency=None)), table)
    quarantine.load(mapped(spark, good("c", currency=None)), table)
    assert [r["position"] for r in quarantine.entries().orderBy("position").collect()] == [1, 2]
    loaded = quarantine.replay(repairs(spark, quarantine, table, lambda raw: raw.replace('"currency": null', '"currency": "eur"')), table)
    assert ids(loaded)[-2:] == [(9, "z"), (10, "c")]
    assert quarantine.open(table).count() == 0


def test_a_replay_that_dies_before_its_commit_is_repeated(spark, tmp_path, table, monkeypatch):
    quarantine = Quarantine(spark, f"{tmp_path}/quarantine")
    quarantine.load(mapped(spark, good(None, created=None)), table)
    fix = repairs(spark, quarantine, table, lambda raw: raw.replace('"created": null', '"created": 5'))

    def die(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "commit", die)
        with pytest.raises(RuntimeError):
            quarantine.replay(fix, table)
    assert quarantine.open(table).count() == 1
    assert ids(quarantine.replay(fix, table)) == [(7, "known"), (8, None)]
    assert ids(quarantine.replay(fix, table)) == [(7, "known"), (8, None)]


def test_unknown_keys_and_empty_batches_change_nothing(spark, tmp_path, table):
    quarantine = Quarantine(spark, f"{tmp_path}/quarantine")
    quarantine.load(mapped(spark, good("a")).where(F.lit(False)), table)
    stray = spark.createDataFrame([("nokey", json.dumps(good("stray")))], "content_key string, raw string")
    assert ids(quarantine.replay(stray, table)) == [(7, "known")]
