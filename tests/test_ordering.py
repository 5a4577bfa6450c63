import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.functions.ordering import RollUp, consecutive_ids, exact_percentile


def test_ids_follow_sparse_positions(spark):
    random.seed(1)
    positions = random.sample(range(200_000), 3000) + [2**32 + 5, 2**32 + 2**16, 3 * 2**32, 7 * 2**32 + 70_000]
    df = spark.createDataFrame([(p,) for p in positions], "position bigint").repartition(7)
    numbered = consecutive_ids(df, "position", "id", start=F.lit(100)).collect()
    assert [row["position"] for row in sorted(numbered, key=lambda row: row["id"])] == sorted(positions)
    assert sorted(row["id"] for row in numbered) == list(range(100, 100 + len(positions)))


def test_ids_of_empty_input(spark):
    assert consecutive_ids(spark.createDataFrame([], "position bigint"), "position", "id").count() == 0


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentile_equals_numpy(spark, fraction):
    rng = np.random.default_rng(3)
    data = {
        "wide": rng.integers(-(2**40), 2**40, 501),
        "tied": rng.integers(0, 3, 1000),
        "even": np.array([1, 2, 3, 2**33]),
        "single": np.array([-5]),
    }
    rows = [(key, int(value)) for key, values in data.items() for value in values] + [(None, 4), (None, 8), ("tied", None)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    got = {row["k"]: row["p"] for row in exact_percentile(df, ["k"], "v", fraction, "p").collect()}
    data[None] = np.array([4, 8])
    assert got == pytest.approx({key: np.percentile(values, fraction * 100) for key, values in data.items()})


def test_percentile_without_keys(spark):
    df = spark.range(10).select(F.col("id").alias("v"))
    assert exact_percentile(df, [], "v", 0.5, "p").first()["p"] == 4.5
    assert exact_percentile(df.where("v > 99"), [], "v", 0.5, "p").count() == 0


def test_percentile_over_the_whole_bigint_range(spark):
    values = [-(2**63), -(2**62), -1, 0, 5, 2**31, 2**47, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = exact_percentile(df, [], "v", 0.25, "q").first().q
    assert float(found) == -1.0
    with_plan = exact_percentile(df, [], "v", 0.5, "q")
    assert "CartesianProduct" not in with_plan._jdf.queryExecution().executedPlan().toString()
    assert float(with_plan.first().q) == 5.0


def test_statistics_of_a_roll_up_equal_those_of_the_rows(spark):
    rows = [(k, None if i % 11 == 0 else f"{(i * i) % 97}.{i % 100:02}") for i in range(400) for k in ("a", None)] + [("one", "5.00"), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v string").select("k", F.col("v").cast("decimal(18,2)").alias("v"))
    rolled = RollUp(df, ["k"], "v", F.col("v") * 100)
    expected = df.groupBy("k").agg(
        F.count("*").alias("rows"), F.count("v").alias("values"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("greatest"),
        F.avg(F.col("v").cast("double")).alias("mean"), F.stddev_samp(F.col("v").cast("double")).alias("deviation"),
    )
    found = {r["k"]: r.asDict() for r in rolled.statistics().collect()}
    for row in expected.collect():
        exact = {c: v for c, v in row.asDict().items() if c not in ("mean", "deviation")}
        assert {c: found[row["k"]][c] for c in exact} == exact
        assert [found[row["k"]][c] for c in ("mean", "deviation")] == pytest.approx([row["mean"], row["deviation"]])
    medians = {r["k"]: r["m"] for r in rolled.percentile(0.5, "m", F.lit(0.01)).collect()}
    assert set(medians) == {"a", None, "one"} and medians["one"] == pytest.approx(5.0)


def test_a_roll_up_reads_the_rows_once_and_skips_equal_digits(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1_000).select((F.col("id") % 5).alias("k"), F.col("id").alias("v")).write.parquet(path)
    rolled = RollUp(spark.read.parquet(path), ["k"], "v", F.col("v"))
    joined = rolled.statistics().join(rolled.percentile(0.5, "m"), "k")
    assert path not in joined._jdf.queryExecution().optimizedPlan().toString() and joined.count() == 5
    assert rolled.percentile(0.5, "m")._jdf.queryExecution().optimizedPlan().toString().count("Window") < 4
