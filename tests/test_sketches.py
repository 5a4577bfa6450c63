from datetime import date

from pyspark.sql import functions as F

from stratamart.operators.sketches import RANK_ERROR, DailySketches, relative_error
from stratamart.sources import semi_structured, sinks


def test_spans_are_unions_of_days(spark, tmp_path):
    rows = spark.range(40_000).select(
        (F.col("id") % 2).alias("half"), (F.col("id") % 9_000).alias("user"), F.col("id").cast("double").alias("amount"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") / 10_000).cast("int")).alias("day"),
    )
    sketches = DailySketches(spark, f"{tmp_path}/s", ["half"], distinct=["user"], quantiles=["amount"])
    assert sketches.days() == []
    for start in (0, 2):
        sketches.refresh(rows.where(F.dayofmonth("day").isin(start + 1, start + 2)), F.col("day"))
    assert sketches.days() == [date(2024, 1, d) for d in (1, 2, 3, 4)]
    for half, n, users, low, median in ((r["half"], r["rows"], r["user_count"], r["amount_low"], r["amount_median"]) for r in sketches.estimate({"low": 0.1, "median": 0.5}).collect()):
        assert half in (0, 1) and n == 20_000
        assert abs(users - 4_500) <= 4_500 * relative_error()
        assert abs(low / 40_000 - 0.1) <= RANK_ERROR and abs(median / 40_000 - 0.5) <= RANK_ERROR
    first = sketches.estimate(last=date(2024, 1, 1)).collect()
    assert {r["rows"] for r in first} == {5_000}
    plan = sketches.read(date(2024, 1, 2), date(2024, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sketch_month" in plan


def test_a_day_is_replaced_and_the_others_stay(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1, date(2024, 1, 1)), ("x", 2, date(2024, 1, 2)), (None, None, date(2024, 1, 2))], "k string, user int, day date")
    sketches = DailySketches(spark, f"{tmp_path}/s", ["k"], distinct=["user"], quantiles=["user"])
    sketches.refresh(rows, F.col("day"))
    sketches.refresh(rows.where("day = '2024-01-02'").withColumn("user", F.col("user") + 5), F.col("day"))
    found = {r["k"]: (r["rows"], r["user_count"], r["user_median"]) for r in sketches.estimate().collect()}
    assert found["x"][:2] == (2, 2) and found[None] == (1, 0, None)


def test_paths_come_from_the_binary_form(spark):
    texts = [('{"a": {"b": [1, 2]}, "s": "x"}',), ("[1]",), ("broken {",), (None,), ('{"a": "text"}',)]
    stored = sinks.stage(semi_structured.as_variant(spark.createDataFrame(texts, "doc string"), "doc"), "variant")
    found = semi_structured.paths(stored, "doc", {"b": ("$.a.b[1]", "int"), "s": ("$.s", "string"), "a": ("$.a", "int")})
    rows = [tuple(r) for r in found.select("b", "s", "a", semi_structured.INVALID).collect()]
    assert sorted(rows, key=repr) == sorted([(2, "x", None, None), (None, None, None, None), (None, None, None, "broken {"), (None, None, None, None), (None, None, None, None)], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "get_json_object" not in plan and "parse_json" not in plan
    assert "OBJECT<" in semi_structured.observed_schema(stored.where("try_variant_get(doc, '$.s', 'string') IS NOT NULL"), "doc")
