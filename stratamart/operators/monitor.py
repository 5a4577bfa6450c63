"""Monitoring queries over the run log.

The log has one ``update_progress`` row per run and one ``flow_progress`` row
per run and dataset. Every time window is relative to ``as_of`` (default: now).
A log kept by date (``record_run``, ``read_log``) has the partition column
``log_date``, the date of ``timestamp``; windows then read their own dates only, and so does a
look at one run, whose flows are logged no earlier than it started.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.clock import seconds_between
from stratamart.functions.literals import literal_rows
from stratamart.operators.gold import ratio

RUN_LOG_SCHEMA = """
    update_id string, event_type string, timestamp timestamp_ntz, state string,
    start_time timestamp_ntz, end_time timestamp_ntz, cause string, error_message string,
    origin struct<dataset: string>, num_output_rows bigint,
    expectations array<struct<dataset: string, name: string, passed_records: bigint, failed_records: bigint>>
"""
RUN, FLOW = "update_progress", "flow_progress"
DATE = "log_date"


def _now(as_of: Column | None) -> Column:
    return F.localtimestamp() if as_of is None else as_of


def _dated_from(log: DataFrame, moment: Column) -> DataFrame:
    """``log`` without the dates before ``moment``, if it is kept by date."""
    return log.where(F.col(DATE) >= F.to_date(moment)) if DATE in log.columns else log


def _within(log: DataFrame, as_of: Column | None, interval: str) -> DataFrame:
    since = _now(as_of) - F.expr(f"INTERVAL {interval}")
    return _dated_from(log, since).where(F.col("timestamp") >= since)


def _seconds(start: str, end: str) -> Column:
    return seconds_between(F.col(start), F.col(end))


def _runs(log: DataFrame) -> DataFrame:
    return log.where(F.col("event_type") == RUN)


def _flows(log: DataFrame) -> DataFrame:
    return log.where(F.col("event_type") == FLOW)


def _latest(rows: DataFrame) -> DataFrame:
    if DATE in rows.columns:
        # The date is found from dates alone; whole rows are read of that date only.
        rows = rows.where(F.col(DATE).eqNullSafe(rows.agg(F.max(DATE)).scalar()))
    return rows.orderBy(F.desc("timestamp"), F.desc("update_id")).limit(1)


def run_history(log: DataFrame, as_of: Column | None = None, n: int = 20) -> DataFrame:
    """The latest ``n`` runs of the last 24 hours."""
    state, cause = F.col("state"), F.col("cause")
    recent = _within(_runs(log), as_of, "24 HOURS")
    return recent.orderBy(F.desc("timestamp"), F.desc("update_id")).limit(n).select(
        "update_id",
        "timestamp",
        F.when(state == "COMPLETED", "SUCCESS").otherwise(state).alias("status"),
        F.round(_seconds("start_time", "end_time") / 60, 1).alias("duration_minutes"),
        F.when(cause == "USER_ACTION", "Manual").when(cause == "SCHEDULE", "Scheduled").otherwise(cause).alias("trigger_type"),
        "error_message",
    )


def expectation_summary(log: DataFrame, as_of: Column | None = None, window: str = "2 HOURS") -> DataFrame:
    """Pass rate per expectation of the latest run that reported flows in the window."""
    recent = _within(_flows(log), as_of, window)
    # One row, so its fields are values to filter by; a flow without a start leaves all dates in.
    latest = recent.agg(F.max_by(F.struct("update_id", "start_time"), F.struct("timestamp", "update_id")).alias("flow"))
    begun = latest.select(F.coalesce("flow.start_time", F.lit("0001-01-01").cast("timestamp_ntz"))).scalar()
    checked = (
        _dated_from(_flows(log), begun)
        .where((F.col("update_id") == latest.select("flow.update_id").scalar()) & F.col("expectations").isNotNull())
        .select(F.explode("expectations").alias("e"))
    )
    passed, failed = F.col("passed_count"), F.col("failed_count")
    rate = F.col("pass_rate_pct")
    return (
        checked.groupBy(F.col("e.dataset").alias("table_name"), F.col("e.name").alias("expectation_name"))
        .agg(F.sum("e.passed_records").alias("passed_count"), F.sum("e.failed_records").alias("failed_count"))
        .withColumn("pass_rate_pct", F.round(ratio(passed, passed + failed) * 100, 2))
        .withColumn("status", F.when(failed == 0, "PASS").when(rate >= 95, "WARNING").otherwise("CRITICAL"))
    )


def row_count_deltas(
    log: DataFrame,
    as_of: Column | None = None,
    window: str = "2 HOURS",
    pairs: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows lost between Bronze and Silver.

    A Bronze table is matched to the Silver name made by replacing the suffix;
    ``pairs`` overrides that for tables whose names differ. A table without a
    match has NULL deltas and status OK.
    """
    counts = (
        _within(_flows(log), as_of, window)
        .groupBy(F.col("origin.dataset").alias("table_name"))
        .agg(F.sum("num_output_rows").alias("row_count"))
    )
    silver_name = F.replace(F.col("table_name"), F.lit("_bronze"), F.lit("_silver"))
    for bronze, silver in (pairs or {}).items():
        silver_name = F.when(F.col("table_name") == bronze, silver).otherwise(silver_name)
    bronze = counts.where(F.col("table_name").endswith("_bronze")).select(
        F.col("table_name").alias("bronze_table"),
        F.col("row_count").alias("bronze_rows"),
        silver_name.alias("silver_table"),
    )
    silver = counts.select(F.col("table_name").alias("silver_table"), F.col("row_count").alias("silver_rows"))
    dropped = F.col("bronze_rows") - F.col("silver_rows")
    share = ratio(dropped, F.col("bronze_rows"))
    return bronze.join(silver, "silver_table", "left").select(
        "bronze_table",
        "bronze_rows",
        "silver_rows",
        dropped.alias("rows_dropped"),
        F.round(share * 100, 2).alias("drop_rate_pct"),
        F.when(share > 0.3, "HIGH DROP RATE").when(share > 0.1, "MODERATE").otherwise("OK").alias("status"),
    )


def latest_run(log: DataFrame, slow_minutes: int = 30) -> DataFrame:
    """One row: the newest run, what it updated, and its health."""
    run = _latest(_runs(log)).select(
        "update_id",
        F.col("timestamp").alias("start_time"),
        F.col("state").alias("status"),
        F.round(_seconds("timestamp", "end_time") / 60, 1).alias("duration_minutes"),
    )
    work = (
        _dated_from(_flows(log), F.coalesce(run.select("start_time").scalar(), F.lit("0001-01-01").cast("timestamp_ntz")))
        .join(run, "update_id", "left_semi")
        .agg(
            F.count_distinct("origin.dataset").alias("tables_updated"),
            F.sum("num_output_rows").alias("total_rows_processed"),
        )
    )
    done, minutes = F.col("status") == "COMPLETED", F.col("duration_minutes")
    health = (
        F.when(done & (minutes < slow_minutes), "HEALTHY")
        .when(done & (minutes >= slow_minutes), "SLOW")
        .when(F.col("status") == "FAILED", "FAILED")
        .otherwise("IN PROGRESS")
    )
    return run.crossJoin(F.broadcast(work)).withColumn("health_status", health)


def duration_anomaly(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest completed run against the completed runs of seven days (itself included).

    With a single run the deviation is NULL and the spike test cannot fire.
    """
    completed = _runs(log).where(F.col("state") == "COMPLETED")
    seconds = _seconds("timestamp", "end_time")
    history = _within(completed, as_of, "7 DAYS").agg(
        (F.avg(seconds) / 60).alias("mean"), (F.stddev_samp(seconds) / 60).alias("deviation")
    )
    newest = _latest(completed).select((seconds / 60).alias("minutes"))
    mean, minutes = F.col("mean"), F.col("minutes")
    return history.crossJoin(F.broadcast(newest)).select(
        F.round(mean, 1).alias("avg_duration_7d"),
        F.round(minutes, 1).alias("latest_duration"),
        F.round(F.try_divide(minutes - mean, mean) * 100, 1).alias("duration_change_pct"),
        F.when(minutes > mean + 2 * F.col("deviation"), "ANOMALY: Duration spike")
        .when(minutes < mean * 0.5, "WARNING: Unusually fast")
        .otherwise("NORMAL")
        .alias("anomaly_status"),
    )


def cdc_lag(changes: DataFrame, as_of: Column | None = None, over_minutes: int | None = 10) -> DataFrame:
    """Minutes since the newest change per ``table_name``; only tables over the limit (None: all)."""
    newest = changes.groupBy("table_name").agg(F.max("_commit_timestamp").alias("latest_cdc_commit"))
    lag = newest.withColumn("lag_minutes", F.timestamp_diff("MINUTE", F.col("latest_cdc_commit"), _now(as_of)))
    return lag if over_minutes is None else lag.where(F.col("lag_minutes") > over_minutes)


def failed_runs(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    return _within(_runs(log), as_of, "24 HOURS").agg(
        F.count_if(F.col("state") == "FAILED").alias("failed_runs")
    )


def conversion_accuracy(currency_distribution: DataFrame, minimum_pct: float = 95.0) -> DataFrame:
    """Currencies whose conversion accuracy is below the limit."""
    return currency_distribution.where(F.col("conversion_accuracy_pct") < minimum_pct).select(
        "currency", "transaction_count", "conversion_accuracy_pct"
    )


@dataclass(frozen=True)
class Threshold:
    """Alert limits; ``inclusive`` compares with >= (<= when low values are bad)."""

    metric: str
    warning: float
    critical: float
    low_is_bad: bool = False
    inclusive: bool = False


# Service thresholds. Two settings exist for the row drop rate.
THRESHOLDS = (
    Threshold("duration_minutes", 30, 60),
    Threshold("pass_rate_pct", 95, 90, low_is_bad=True),
    Threshold("drop_rate_pct", 30, 50),
    Threshold("cdc_lag_minutes", 10, 30),
    Threshold("failed_runs", 1, 3, inclusive=True),
    Threshold("conversion_accuracy_pct", 95, 90, low_is_bad=True),
)
STRICT_DROP_RATE = Threshold("drop_rate_pct", 10, 30)


def alerts(metrics: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Warning and critical rows of ``metrics(metric, subject, value)``; unknown metrics raise none."""
    limits = literal_rows(
        metrics.sparkSession,
        ("metric", "warning", "critical", "low_is_bad", "inclusive"),
        [(t.metric, float(t.warning), float(t.critical), t.low_is_bad, t.inclusive) for t in thresholds],
    )
    value = F.col("value")

    def beyond(limit: str) -> Column:
        over = F.when(F.col("low_is_bad"), value < F.col(limit)).otherwise(value > F.col(limit))
        return over | (F.col("inclusive") & (value == F.col(limit)))

    severity = F.when(beyond("critical"), "CRITICAL").when(beyond("warning"), "WARNING")
    return (
        metrics.join(F.broadcast(limits), "metric")
        .withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
        .select("metric", "subject", "value", "severity")
    )


def alert_metrics(
    log: DataFrame, changes: DataFrame, as_of: Column | None = None, currency_distribution: DataFrame | None = None
) -> DataFrame:
    """The metrics the thresholds are about, as ``(metric, subject, value)``.

    Conversion accuracy is one of them where ``currency_distribution`` is given;
    take the one of all payments, as dropping mismatches hides them.
    """

    def rows(df: DataFrame, metric: str, subject: Column, value: str) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), subject.alias("subject"), F.col(value).cast("double").alias("value"))

    summary = expectation_summary(log, as_of)
    rule = F.concat_ws(".", "table_name", "expectation_name")
    metrics = (
        rows(latest_run(log), "duration_minutes", F.col("update_id"), "duration_minutes")
        .unionByName(rows(summary, "pass_rate_pct", rule, "pass_rate_pct"))
        .unionByName(rows(row_count_deltas(log, as_of), "drop_rate_pct", F.col("bronze_table"), "drop_rate_pct"))
        .unionByName(rows(cdc_lag(changes, as_of, None), "cdc_lag_minutes", F.col("table_name"), "lag_minutes"))
        .unionByName(rows(failed_runs(log, as_of), "failed_runs", F.lit("last 24 hours"), "failed_runs"))
    )
    if currency_distribution is None:
        return metrics
    accuracy = rows(currency_distribution, "conversion_accuracy_pct", F.col("currency"), "conversion_accuracy_pct")
    return metrics.unionByName(accuracy)


# --- writing the log ------------------------------------------------------------


def run_entries(
    spark: SparkSession,
    update_id: str,
    started: datetime,
    ended: datetime,
    state: str,
    cause: str,
    error: str | None,
    flows: Mapping[str, tuple[int, Mapping[str, tuple[int, int]]]],
) -> DataFrame:
    """Log rows of one run. ``flows``: dataset -> (rows written, {rule: (passed, failed)})."""
    run = (update_id, RUN, started, state, started, ended, cause, error, None, None, None)
    work = [
        (update_id, FLOW, ended, state, started, ended, cause, None, (dataset,), written,
         [(dataset, rule, passed, failed) for rule, (passed, failed) in rules.items()] or None)
        for dataset, (written, rules) in flows.items()
    ]
    return spark.createDataFrame([run, *work], RUN_LOG_SCHEMA)


def record_run(entries: DataFrame, path: str) -> None:
    """Append one run's entries to the log table, under their dates.

    The entries are dealt out by date and sized by what they hold: those of one run are one file a
    date, and a date with many entries is written by several tasks, each of which sorts its share only.
    """
    dated = entries.withColumn(DATE, F.to_date("timestamp"))
    dated.hint("rebalance", DATE).write.mode("append").partitionBy(DATE).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log, with ``log_date`` for the windows to select by."""
    return spark.read.schema(f"{RUN_LOG_SCHEMA.strip()}, {DATE} date").parquet(path)
