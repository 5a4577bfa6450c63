from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratamart.operators import expectations as expect
from stratamart.operators import monitor, quality
from stratamart.plans import medallion
from stratamart.sources import sinks
from verification.registry import Tables

T0 = datetime(2024, 1, 10, 12)


def as_of():
    return F.lit("2024-01-10 13:00:00").cast("timestamp_ntz")


def run(update_id, start, minutes, state="COMPLETED"):
    end = start + timedelta(minutes=minutes)
    return (update_id, monitor.RUN, start, state, start, end, "SCHEDULE", None, None, None, None)


def flow(update_id, at, dataset, n, *rules):
    checks = [(dataset, name, passed, failed) for name, passed, failed in rules] or None
    return (update_id, monitor.FLOW, at, None, None, None, None, None, (dataset,), n, checks)


def log(spark, *entries):
    return spark.createDataFrame(list(entries), monitor.RUN_LOG_SCHEMA)


def test_anomaly_of_a_single_run_is_normal(spark):
    row = monitor.duration_anomaly(log(spark, run("a", T0, 90)), as_of()).first()
    assert (row["avg_duration_7d"], row["duration_change_pct"], row["anomaly_status"]) == (90.0, 0.0, "NORMAL")


@pytest.mark.parametrize("minutes, status", [(200, "ANOMALY: Duration spike"), (10, "NORMAL"), (2, "WARNING: Unusually fast")])
def test_anomaly(spark, minutes, status):
    history = [run(f"h{i}", T0 - timedelta(hours=i + 1), 10 + i % 2) for i in range(12)]
    assert monitor.duration_anomaly(log(spark, *history, run("z", T0, minutes)), as_of()).first()["anomaly_status"] == status


def test_anomaly_ignores_old_and_unfinished_runs(spark):
    entries = [run("old", T0 - timedelta(days=8), 500), run("failed", T0, 500, "FAILED"), run("a", T0 - timedelta(hours=1), 10)]
    assert monitor.duration_anomaly(log(spark, *entries), as_of()).first()["avg_duration_7d"] == 10.0


def test_history_window_and_labels(spark):
    entries = [run("new", T0, 61.5), run("bad", T0 - timedelta(hours=2), 1, "FAILED"), run("odd", T0 - timedelta(hours=3), 1, "QUEUED"),
               run("edge", T0 - timedelta(hours=23), 1), run("old", T0 - timedelta(hours=23, seconds=1), 1)]
    got = monitor.run_history(log(spark, *entries), as_of()).collect()
    assert [(r["update_id"], r["status"]) for r in got] == [("new", "SUCCESS"), ("bad", "FAILED"), ("odd", "QUEUED"), ("edge", "SUCCESS")]
    assert got[0]["duration_minutes"] == 61.5 and got[0]["trigger_type"] == "Scheduled"
    assert monitor.failed_runs(log(spark, *entries), as_of()).first()[0] == 1


def test_expectations_of_the_latest_run_by_time(spark, rows):
    entries = [
        flow("z_old", T0 - timedelta(minutes=30), "t", 5, ("r", 1, 99)),
        flow("a_new", T0, "t", 5, ("all", 10, 0), ("most", 95, 5), ("few", 94, 6), ("none", 0, 0)),
        flow("a_new", T0, "u", 5),
    ]
    got = rows(monitor.expectation_summary(log(spark, *entries), as_of()), "expectation_name", "pass_rate_pct", "status")
    assert got == sorted([("all", 100.0, "PASS"), ("most", 95.0, "WARNING"), ("few", 94.0, "CRITICAL"), ("none", None, "PASS")], key=repr)


@pytest.mark.parametrize("silver, status", [(100, "OK"), (90, "OK"), (89, "MODERATE"), (70, "MODERATE"), (69, "HIGH DROP RATE")])
def test_row_deltas(spark, silver, status):
    entries = [flow("a", T0, "x_bronze", 100), flow("a", T0, "x_silver", silver), flow("a", T0, "orders_bronze", 0)]
    got = {r["bronze_table"]: r for r in monitor.row_count_deltas(log(spark, *entries), as_of()).collect()}
    assert got["x_bronze"]["status"] == status and got["x_bronze"]["rows_dropped"] == 100 - silver
    assert got["orders_bronze"]["silver_rows"] is None and got["orders_bronze"]["status"] == "OK"


def test_latest_run_health(spark):
    for minutes, state, health in [(29, "COMPLETED", "HEALTHY"), (30, "COMPLETED", "SLOW"), (5, "FAILED", "FAILED"), (5, "RUNNING", "IN PROGRESS")]:
        entries = [run("old", T0 - timedelta(days=1), 1), run("a", T0, minutes, state), flow("a", T0, "x", 3), flow("a", T0, "x", 4), flow("old", T0, "y", 9)]
        row = monitor.latest_run(log(spark, *entries)).first()
        assert (row["update_id"], row["tables_updated"], row["total_rows_processed"], row["health_status"]) == ("a", 1, 7, health)


def test_windows_open_their_own_dates_only(spark, rows, tmp_path):
    """Files of dates outside a window are no Parquet at all, so reading one would fail."""
    path = str(tmp_path / "log")
    day = timedelta(days=1)
    late = T0 + timedelta(hours=12, minutes=30)  # half past midnight
    entries = [
        *(run(f"r{i}", T0 - i * day, 10) for i in range(30)),
        *(flow(f"r{i}", T0 - i * day, "x_bronze", 10, ("r", 1, 99)) for i in range(30)),
        run("night", late - timedelta(hours=1), 60),
        (*flow("night", late, "x_bronze", 100, ("rule", 95, 5))[:4], late - timedelta(hours=1), *flow("night", late, "x_bronze", 100, ("rule", 95, 5))[5:]),
        (*flow("night", late - timedelta(minutes=50), "x_silver", 80, ("early", 1, 0))[:4], late - timedelta(hours=1),
         *flow("night", late - timedelta(minutes=50), "x_silver", 80, ("early", 1, 0))[5:]),
    ]
    whole = log(spark, *entries)
    monitor.record_run(whole, path)
    now = F.lit(str(late + timedelta(minutes=20))).cast("timestamp_ntz")
    forms = [
        lambda source: monitor.run_history(source, now),
        lambda source: monitor.expectation_summary(source, now),
        lambda source: monitor.row_count_deltas(source, now),
        lambda source: monitor.failed_runs(source, now),
    ]
    expected = [rows(form(whole)) for form in forms]
    assert [row["expectation_name"] for row in forms[1](whole).collect()] in (["rule", "early"], ["early", "rule"])
    dated = monitor.read_log(spark, path)
    assert rows(monitor.latest_run(dated)) == rows(monitor.latest_run(whole))
    assert rows(monitor.duration_anomaly(dated, now)) == rows(monitor.duration_anomaly(whole, now))
    for folder in (tmp_path / "log").glob("log_date=*"):
        if folder.name < "log_date=2024-01-10":
            for file in folder.glob("*.parquet"):
                file.write_text("not read")
    (tmp_path / "log").joinpath("_SUCCESS").unlink()
    for file in (tmp_path / "log").glob("log_date=*/.*.crc"):
        file.unlink()
    assert [rows(form(monitor.read_log(spark, path))) for form in forms] == expected


def test_a_large_log_is_written_by_several_tasks(spark, tmp_path):
    """One run is one file a date; a date with many entries does not go through a single task."""
    folder = lambda path, date: list((path / f"log_date={date}").glob("*.parquet"))
    monitor.record_run(log(spark, run("a", T0, 10), *(flow("a", T0, f"t{i}", i) for i in range(40))), str(tmp_path / "small"))
    assert len(folder(tmp_path / "small", "2024-01-10")) == 1

    entries = spark.range(0, 60_000, 1, 6).selectExpr(
        "concat('u', sha2(string(id), 256)) AS update_id", "'flow_progress' AS event_type",
        "timestamp_ntz'2024-01-10 12:00:00' + make_dt_interval(if(id % 50 = 0, 1, 0)) AS timestamp",
        "string(null) AS state", "cast(null AS timestamp_ntz) AS start_time", "cast(null AS timestamp_ntz) AS end_time", "string(null) AS cause",
        "string(null) AS error_message", "struct('t' AS dataset) AS origin", "id AS num_output_rows",
    ).withColumn("expectations", F.lit(None).cast(log(spark).schema["expectations"].dataType))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "512k")
    try:
        monitor.record_run(entries, str(tmp_path / "large"))
    finally:
        spark.conf.set(size, before)
    assert len(folder(tmp_path / "large", "2024-01-10")) > 1 and len(folder(tmp_path / "large", "2024-01-11")) == 1
    written = monitor.read_log(spark, str(tmp_path / "large"))
    assert written.count() == 60_000 and written.select(*entries.columns).exceptAll(entries).isEmpty()


def test_alert_limits(spark, rows):
    metrics = spark.createDataFrame(
        [("duration_minutes", "at", 30.0), ("duration_minutes", "over", 30.1), ("duration_minutes", "far", 60.1),
         ("pass_rate_pct", "at", 95.0), ("pass_rate_pct", "under", 94.9), ("pass_rate_pct", "far", 89.9),
         ("failed_runs", "none", 0.0), ("failed_runs", "one", 1.0), ("failed_runs", "three", 3.0),
         ("drop_rate_pct", "d", 20.0), ("unknown", "u", 1e9), ("cdc_lag_minutes", "null", None)],
        "metric string, subject string, value double",
    )
    got = rows(monitor.alerts(metrics), "metric", "subject", "severity")
    assert got == [
        ("duration_minutes", "far", "CRITICAL"), ("duration_minutes", "over", "WARNING"),
        ("failed_runs", "one", "WARNING"), ("failed_runs", "three", "CRITICAL"),
        ("pass_rate_pct", "far", "CRITICAL"), ("pass_rate_pct", "under", "WARNING"),
    ]
    strict = [t for t in monitor.THRESHOLDS if t.metric != "drop_rate_pct"] + [monitor.STRICT_DROP_RATE]
    assert ("drop_rate_pct", "d", "WARNING") in rows(monitor.alerts(metrics, strict), "metric", "subject", "severity")


def test_lag(spark, rows):
    changes = spark.createDataFrame(
        [("a", T0), ("a", T0 + timedelta(minutes=45)), ("b", T0 + timedelta(minutes=50))], "table_name string, _commit_timestamp timestamp_ntz"
    )
    assert rows(monitor.cdc_lag(changes, as_of()), "table_name", "lag_minutes") == [("a", 15)]


def test_checks_and_freshness(spark, rows):
    products = spark.createDataFrame([(1, 0.0), (None, 2.0)], "product_id int, price double")
    got = {r["test"]: (r["status"], r["message"]) for r in quality.product_checks(products).collect()}
    assert got["product_schema: product_name"] == ("FAILED", "Column product_name not found")
    assert got["no_null_product_ids"] == ("FAILED", "Found 1 null values in product_id")
    assert got["all_prices_are_positive"] == ("FAILED", "Found 1 products with non-positive prices")
    times = spark.createDataFrame([(T0,)], "ts timestamp_ntz")
    assert quality.freshness(times, "ts", 60, as_of()).first()["is_fresh"]
    assert not quality.freshness(times, "ts", 59, as_of()).first()["is_fresh"]
    assert quality.freshness(times.where("false"), "ts", 60, as_of()).first()["is_fresh"] is False


def test_missing_country_of_no_customers(spark):
    empty = spark.createDataFrame([], "country string, active_status_is_correct boolean")
    assert tuple(quality.missing_country(empty).first()) == (0, 0, 0.0)
    assert quality.status_conflicts(empty).first()["pct"] == 0.0


def test_runs_are_logged_and_a_failure_keeps_published_tables(spark, tmp_path):
    bronze = Tables(spark, "/root/testdata/sf0.001").bronze()
    out, log_path = str(tmp_path / "tables"), str(tmp_path / "log")
    medallion.run(spark, bronze, out, log_path, update_id="first")
    before = sinks.read(spark, f"{out}/payment_silver").count()
    broken = {**bronze, "payment_postgres": bronze["payment_postgres"].withColumn("amount", -F.col("amount"))}
    with pytest.raises(expect.ExpectationFailed):
        medallion.run(spark, broken, out, log_path, update_id="second")
    assert sinks.read(spark, f"{out}/payment_silver").count() == before
    runs = {r["update_id"]: r for r in monitor.read_log(spark, log_path).where("event_type = 'update_progress'").collect()}
    assert {key: row["state"] for key, row in runs.items()} == {"first": "COMPLETED", "second": "FAILED"}
    assert "valid_payment_amount" in runs["second"]["error_message"]
    flows = monitor.read_log(spark, log_path).where("event_type = 'flow_progress' AND update_id = 'first'")
    assert flows.count() == 21
