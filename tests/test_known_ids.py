"""The id index: what it finds, and how little of it a lookup reads."""

import json

import pytest
from pyspark.sql import functions as F

from stratamart.operators import ingest
from stratamart.sources import payment_export
from stratamart.sources.known_ids import FEW, ID, KnownIds
from stratamart.streaming import payments


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], f"{ID} string")


def loaded(spark, values, run="r", batch=0):
    return ids(spark, values).select(ID, F.lit(run).alias("run"), F.lit(batch).alias("batch_id"))


@pytest.fixture
def index(spark, tmp_path):
    index = KnownIds(spark, str(tmp_path / "known"), buckets=16)
    index.add(loaded(spark, [f"id{i}" for i in range(3_000)]))
    index.add(loaded(spark, ["late", None, "é"], batch=1))
    return index


@pytest.mark.parametrize("n", [0, 1, 25, FEW, FEW + 1, 5_000])
def test_matching_equals_a_semi_join(spark, rows, index, n):
    wanted = [f"id{i}" for i in range(2_990, 2_990 + n)] + (["late", "é", "unknown"] if n == 25 else [])
    expected = sorted((v,) for v in set(wanted) & ({f"id{i}" for i in range(3_000)} | {"late", "é"}))
    assert rows(index.matching(ids(spark, wanted)).distinct()) == expected


def test_own_batch_does_not_count(spark, rows, index):
    assert rows(index.matching(ids(spark, ["id1", "late"]), "r", 1)) == [("id1",)]
    assert rows(index.matching(ids(spark, ["id1", "late"]), "r", 0)) == [("late",)]


def scan_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_id_reads_one_bucket(spark, index):
    found = index.matching(ids(spark, ["id7"]))
    own = index.table().where(F.col(ID) == "id7").first()["id_bucket"]
    plan = scan_plan(found)
    assert f"= {own})" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "EqualTo(stripe_payment_id,id7)" in plan


def test_many_ids_prune_buckets_while_running(spark, index):
    in_few = [r[ID] for r in index.table().where(F.col("id_bucket") < 4).limit(FEW + 50).collect()]
    found = index.matching(ids(spark, in_few))
    assert found.count() == len(in_few) > FEW
    assert "dynamicpruning" in scan_plan(found)


def test_files_carry_bloom_filters(spark, index):
    hadoop = spark._jvm.org.apache.parquet.hadoop
    for name in index.table().inputFiles():
        source = hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(name), spark._jsc.hadoopConfiguration())
        with_filters = hadoop.ParquetFileReader.open(source)
        offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for b in with_filters.getFooter().getBlocks() for c in b.getColumns()}
        with_filters.close()
        assert offsets[ID] > 0 and offsets["run"] < 0


def test_compaction_keeps_everything_in_one_file_a_bucket(spark, rows, index):
    before = rows(index.table())
    index.add(loaded(spark, ["late"], batch=1))
    index.compact()
    assert rows(index.table()) == before
    assert len(index.table().inputFiles()) == len({r["id_bucket"] for r in index.table().collect()})
    index.add(loaded(spark, ["after"], batch=2))
    assert index.matching(ids(spark, ["after", "late"])).count() == 2


def test_sync_adds_only_what_is_missing(spark, rows, index):
    index.sync(loaded(spark, ["id1", "new"]))
    assert index.table().where(F.col(ID).isin("id1", "new")).count() == 2


def test_a_batch_lost_before_its_ids_is_found_by_another_checkpoint(spark, rows, tmp_path, monkeypatch):
    base = spark.createDataFrame([(10, "old")], "payment_id bigint, stripe_payment_id string")
    path = str(tmp_path / "out")

    def batch(*names):
        raw = [(i, json.dumps({"id": n, "amount_received": 1, "currency": "usd", "created": 0})) for i, n in enumerate(names)]
        return ingest.map_payments(payment_export.parse_payments(spark.createDataFrame(raw, "position bigint, raw string")))

    def lost(*_):
        raise RuntimeError("lost")

    load = payments.upsert_batch(base, path, lambda: "first")
    load(batch("a"), 0)
    with monkeypatch.context() as broken:
        broken.setattr(KnownIds, "add", lost)
        with pytest.raises(RuntimeError):
            load(batch("b"), 1)
    payments.upsert_batch(base, path, lambda: "second")(batch("a", "b", "old", "c"), 0)
    assert rows(payments.read_loaded(spark, path), "payment_id", "stripe_payment_id") == [(11, "a"), (12, "b"), (13, "c")]
