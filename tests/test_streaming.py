import json

import pytest
from pyspark.sql import functions as F

from stratamart.operators import expectations as expect
from stratamart.operators import ingest
from stratamart.sources import payment_export
from stratamart.streaming import bronze, keyed, payments, schema_log


def export(*ids, start=0, **fields):
    return [
        (start + i, json.dumps({"id": id_, "amount_received": 100, "currency": "usd", "created": 0, **fields}))
        for i, id_ in enumerate(ids)
    ]


RAW = "position bigint, raw string"


def land(spark, rows, path):
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(path)


def load(spark, source, base, target, checkpoint):
    stream = bronze.bronze_stream(spark, source, RAW, max_files=1)
    payments.stream_payments(ingest.map_payments(payment_export.parse_payments(stream)), base, target, checkpoint)


def test_payments_over_several_batches(spark, rows, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    base = spark.createDataFrame([(10, "old")], "payment_id bigint, stripe_payment_id string")
    land(spark, export("a", "old", "a", "b"), source)
    load(spark, source, base, target, checkpoint)
    assert rows(payments.read_loaded(spark, target), "payment_id", "stripe_payment_id") == [(11, "a"), (12, "b")]
    land(spark, export("b", "c", start=10), source)
    land(spark, export("c", "d", start=20), source)
    load(spark, source, base, target, checkpoint)
    loaded = rows(payments.read_loaded(spark, target), "payment_id", "stripe_payment_id")
    assert sorted(i for i, _ in loaded) == [11, 12, 13, 14]
    assert sorted(name for _, name in loaded) == ["a", "b", "c", "d"]
    load(spark, source, base, target, checkpoint)
    assert rows(payments.read_loaded(spark, target), "payment_id", "stripe_payment_id") == loaded


def test_new_checkpoint_keeps_what_is_loaded(spark, rows, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    base = spark.createDataFrame([(1, "old")], "payment_id bigint, stripe_payment_id string")
    bad = export("e", start=7, currency=None)
    land(spark, export("a", "b") + bad, source)
    load(spark, source, base, target, str(tmp_path / "cp1"))
    other = str(tmp_path / "in2")
    land(spark, export("b", "c"), other)
    load(spark, other, base, target, str(tmp_path / "cp2"))
    assert rows(payments.read_loaded(spark, target), "payment_id", "stripe_payment_id") == [(2, "a"), (3, "b"), (4, "c")]
    assert rows(payments.read_quarantine(spark, target), "stripe_payment_id", "error_reason") == [("e", "currency is null")]
    counts = payments.read_summary(spark, target)
    assert rows(counts, "payments_read", "payments_inserted", "payments_skipped", "errors") == [(2, 1, 1, 0), (3, 2, 0, 1)]


def test_replayed_batch_writes_the_same_rows(spark, rows, tmp_path):
    base = spark.createDataFrame([(10, "old")], "payment_id bigint, stripe_payment_id string")
    load_batch = payments.upsert_batch(base, str(tmp_path / "out"))

    def batch(*ids):
        return ingest.map_payments(payment_export.parse_payments(spark.createDataFrame(export(*ids), RAW)))

    load_batch(batch("a", "b"), 0)
    load_batch(batch("b", "c"), 1)
    once = rows(payments.read_loaded(spark, str(tmp_path / "out")))
    load_batch(batch("b", "c"), 1)
    assert rows(payments.read_loaded(spark, str(tmp_path / "out"))) == once
    assert [row[0] for row in once] == [11, 12, 13]


@pytest.mark.parametrize("columns", [["position", "raw"], ["raw"]])
def test_a_file_of_one_row_group_is_parsed_by_several_tasks(spark, tmp_path, columns):
    source, held = str(tmp_path / "in"), []
    # With positions, one text over and over.
    land(spark, export(*(["a"] * 2_000 if "position" in columns else map(str, range(2_000)))), source)
    stream = payment_export.parse_payments(bronze.bronze_stream(spark, source, RAW).select(*columns))

    def count(batch, _):
        held.extend(row["count"] for row in batch.groupBy(F.spark_partition_id()).count().collect())

    # So few rows would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        query = stream.writeStream.foreachBatch(count).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(held) == 2_000 and max(held) < 1_000


def test_stream_expectations_drop_and_fail(spark, rows, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    schema = "order_id int, quantity int"

    def feed(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)
        stream = bronze.bronze_stream(spark, source, schema)
        payments.apply_stream(stream, "order_silver", expect.ORDER_RULES, target, checkpoint)

    feed((1, 2), (2, 0), (3, None))
    assert rows(payments.read_loaded(spark, target), "order_id") == [(1,)]
    with pytest.raises(Exception, match="valid_order_id"):
        feed((4, 1), (None, 1))
    assert rows(payments.read_loaded(spark, target), "order_id") == [(1,)]


def test_only_new_files_are_ingested(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))

    def ingest_now():
        bronze.run_available_now(bronze.bronze_stream(spark, source, "id bigint"), target, checkpoint)
        return bronze.read_bronze(spark, target, "id bigint").count()

    spark.range(5).write.parquet(source)
    assert [ingest_now(), ingest_now()] == [5, 5]
    spark.range(3).write.mode("append").parquet(source)
    assert ingest_now() == 8


def test_new_columns_after_restart(spark, rows, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    old, new = spark.range(1), spark.range(1, 2).selectExpr("id", "'x' AS extra")
    old.write.parquet(source)
    bronze.run_available_now(bronze.bronze_stream(spark, source, old.schema), target, checkpoint)
    new.write.mode("append").parquet(source)
    widened = bronze.widen_schema(old.schema, new.schema)
    assert widened.names == ["id", "extra"] and bronze.widen_schema(widened, old.schema) == widened
    bronze.run_available_now(bronze.bronze_stream(spark, source, widened), target, checkpoint)
    assert rows(bronze.read_bronze(spark, target, widened)) == [(0, None), (1, "x")]


def test_csv_source_and_continuous_mode(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    spark.range(4).write.option("header", True).csv(source)
    stream = bronze.bronze_stream(spark, source, "id bigint", "csv", header="true")
    query = bronze.start_continuous(stream, target, checkpoint, "1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert bronze.read_bronze(spark, target, "id bigint").count() == 4


def test_latest_by_key(spark, rows):
    feed = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None), (None, 1, "n"), (None, 2, "m"), (3, None, "x"), (3, 1, "y")],
        "k int, seq int, v string",
    )
    assert rows(bronze.latest_by_key(feed, ["k"], "seq")) == sorted(
        [(1, 3, "c"), (2, 1, None), (None, 2, "m"), (3, 1, "y")], key=repr)


def test_ten_tables_are_known():
    assert len(bronze.BRONZE_TABLES) == 10


def test_new_columns_are_noticed(spark, rows, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    log = schema_log.SchemaLog(spark, str(tmp_path / "log"))

    def land_and_ingest(df, **options):
        df.coalesce(1).write.mode("append").parquet(landing)
        schema_log.ingest_evolving(spark, landing, log, target, checkpoint, **options)
        return rows(schema_log.read_evolved(spark, log, target))

    assert land_and_ingest(spark.range(1)) == [(0,)]
    # A file with two new columns and, in another batch, one without any.
    spark.range(1, 2).selectExpr("'x' AS extra", "id", "2.5D AS `a.b`").coalesce(1).write.mode("append").parquet(landing)
    wider = land_and_ingest(spark.range(2, 3), max_files=1)
    assert wider == sorted([(0, None, None), (1, "x", 2.5), (2, None, None)], key=repr)
    assert rows(log.history(), "version", "added") == [(1, ["id"]), (2, ["extra", "a.b"])]
    # Nothing new: no row is added, no version either.
    schema_log.ingest_evolving(spark, landing, log, target, checkpoint)
    assert rows(schema_log.read_evolved(spark, log, target)) == wider and log.current()[0] == 2
    # Another spelling is the same column; an empty file does no harm.
    assert len(land_and_ingest(spark.range(3, 4).withColumnRenamed("id", "ID"))) == 4
    assert len(land_and_ingest(spark.range(0).selectExpr("id", "'y' AS extra"))) == 4
    assert log.current()[0] == 2


def test_changed_type_stops_the_ingest(spark, rows, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    log = schema_log.SchemaLog(spark, str(tmp_path / "log"))
    spark.range(1).write.parquet(landing)
    schema_log.ingest_evolving(spark, landing, log, target, checkpoint)
    spark.range(1).selectExpr("CAST(id AS STRING) AS id", "1 AS more").write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="id: bigint became string"):
        schema_log.ingest_evolving(spark, landing, log, target, checkpoint)
    assert rows(schema_log.read_evolved(spark, log, target)) == [(0,)] and log.current()[0] == 1


def test_evolved_bronze_is_read_without_footers(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("in 1% +x", "out", "cp"))
    log = schema_log.SchemaLog(spark, str(tmp_path / "log"))
    spark.range(3).write.parquet(landing)
    schema_log.ingest_evolving(spark, landing, log, target, checkpoint)
    (tmp_path / "out" / "broken.parquet").write_text("no footer here")
    assert schema_log.read_evolved(spark, log, target).schema.names == ["id"]
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).parquet(target)
    (tmp_path / "out" / "broken.parquet").unlink()
    assert schema_log.read_evolved(spark, log, target).count() == 3


CHANGES = "k int, seq int, v string"


def test_latest_stream_equals_the_batch_form(spark, rows, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    batches = [
        [(1, 5, "a"), (2, 1, None), (None, 1, "n"), (3, None, "x")],
        [(1, 4, "late"), (2, 2, "b"), (4, 1, "new"), (3, 0, "y")],
        [(1, 5, "b"), (1, 5, "a"), (2, 0, "late"), (None, 2, "m"), (2, 2, "b")],
    ]
    seen = []
    for batch in batches:
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(source)
        # A new session of the stream each time: the state comes from the checkpoint.
        feed = bronze.bronze_stream(spark, source, CHANGES)
        table = keyed.KeyedTable(spark, str(tmp_path / "out"), feed.schema, ["k"], 8)
        keyed.stream_latest(feed, table, "seq", checkpoint)
        seen += batch
        assert rows(table.read()) == rows(bronze.latest_by_key(spark.createDataFrame(seen, CHANGES), ["k"], "seq"))
    feed = bronze.bronze_stream(spark, source, CHANGES, max_files=1)
    keyed.stream_latest(feed, table, "seq", str(tmp_path / "other"))
    assert rows(table.read()) == rows(bronze.latest_by_key(spark.createDataFrame(seen, CHANGES), ["k"], "seq"))


def test_keyed_merge_writes_touched_buckets_and_is_idempotent(spark, rows, tmp_path):
    schema = spark.createDataFrame([], CHANGES).schema
    table = keyed.KeyedTable(spark, str(tmp_path / "out"), schema, ["k"], 16)
    assert table.read().count() == 0 and table.merge(spark.createDataFrame([], schema), "seq") == []
    table.merge(spark.createDataFrame([(i, 1, "a") for i in range(200)], CHANGES), "seq")
    before = table._manifest()
    change = spark.createDataFrame([(7, 2, "b"), (7, 0, "late")], CHANGES)
    (bucket,) = table.merge(change, "seq")
    after = table._manifest()
    assert [b for b in before if before[b] != after[b]] == [bucket] and len(after) == 16
    once = rows(table.read())
    table.merge(change, "seq")
    assert rows(table.read()) == once and len(once) == 200 and (7, 2, "b") in once
    assert table.collect_garbage() == []
    # The newest manifest names the first folder (15 buckets) and the last; the one between goes.
    assert len(table.collect_garbage(keep=1, min_age=0, abandoned_after=0)) == 1
    assert rows(table.read()) == once


def test_paths_are_taken_literally():
    assert schema_log._literal_path("file:/a%20b/50%25/k=%5B1%5D/*.parquet") == "file:/a b/50%/k=\\[1\\]/\\*.parquet"
