"""Streaming payment load and per-batch expectations."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratamart.operators import expectations as expect
from stratamart.operators import ingest
from stratamart.sources import sinks
from stratamart.sources.known_ids import KnownIds

RUN, BATCH = "run", "batch_id"
LOADED, QUARANTINE, SUMMARY, KNOWN = "loaded", "quarantine", "summary", "known"
BASE = "base"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint gives its query: stable over restarts, new with a new checkpoint."""
    text = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(text)["id"]


def _loaded(spark: SparkSession, path: str) -> DataFrame:
    """(payment_id, stripe_payment_id, run, batch_id) of everything the batches of all runs wrote."""
    schema = f"payment_id bigint, stripe_payment_id string, {RUN} string, {BATCH} int"
    folder = f"{path}/{LOADED}"
    if not sinks.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("ignoreMissingFiles", True).parquet(folder)


def upsert_batch(base: DataFrame, path: str, run: Callable[[], str] = lambda: "run") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads each micro-batch of mapped payments.

    ``base`` is the payment table before streaming. Each batch owns the folders
    ``run=R/batch_id=N`` of the loaded rows, the quarantine and the summary,
    and overwrites only those. ``run`` names the checkpoint, so a new
    checkpoint on an existing target numbers its batches anew without touching
    what is loaded. Known are the base table and all *other* batches of all
    runs, so replaying a batch writes the same rows again.

    What is known is looked up in an index of ids (``known_ids``), which a
    batch joins last. At the start the index is brought up to the base and
    the loaded rows, the only time they are scanned: a batch lost between its
    rows and its ids is found then.
    """
    spark = base.sparkSession
    known_base = ingest.evolve(base).select("payment_id", "stripe_payment_id")
    # One row; the base does not change while the stream runs.
    base_maximum = known_base.agg(F.max("payment_id")).first()[0] or 0
    known = KnownIds(spark, f"{path}/{KNOWN}")
    last: dict[str, int] = {}

    def start() -> None:
        ids = known_base.select("stripe_payment_id", F.lit(BASE).alias(RUN), F.lit(-1).cast("bigint").alias(BATCH))
        written = _loaded(spark, path).select("stripe_payment_id", RUN, F.col(BATCH).cast("bigint").alias(BATCH))
        known.sync(ids.unionByName(written).where(F.col("stripe_payment_id").isNotNull()))

    def load(mapped: DataFrame, batch_id: int) -> None:
        name = run()
        own = f"{RUN}={name}/{BATCH}={batch_id}"
        # The largest id is carried from batch to batch and looked up only at the start or on a replay.
        if last.get("batch") != batch_id - 1:
            start()
            others = _loaded(spark, path).where((F.col(RUN) != name) | (F.col(BATCH) != batch_id))
            last["maximum"] = max(base_maximum, others.agg(F.max("payment_id")).first()[0] or 0)
        taken = spark.range(1).select(F.lit(last["maximum"]).cast("bigint").alias("payment_id"))
        with sinks.staged(mapped, "stream_batch") as batch:
            judging = ingest.classify(batch, lambda ids: known.matching(ids, name, batch_id))
            with sinks.staged(judging, "stream_status") as judged:
                accepted = judged.where(F.col("load_status") == ingest.INSERTED)
                numbered = ingest.assign_ids(accepted, taken).select("payment_id", *ingest.LOADED_COLUMNS)
                numbered.write.mode("overwrite").parquet(f"{path}/{LOADED}/{own}")
                bad = judged.where(F.col("load_status") == ingest.ERROR).drop("load_status")
                bad.write.mode("overwrite").parquet(f"{path}/{QUARANTINE}/{own}")
                counts = ingest.summarise(judged)
                counts.write.mode("overwrite").parquet(f"{path}/{SUMMARY}/{own}")
        known.add(spark.read.parquet(f"{path}/{LOADED}/{own}").select("stripe_payment_id", F.lit(name).alias(RUN), F.lit(batch_id).alias(BATCH)))
        inserted = spark.read.parquet(f"{path}/{SUMMARY}/{own}").first()["payments_inserted"]
        last.update(batch=batch_id, maximum=last["maximum"] + inserted)

    return load


def stream_payments(mapped: DataFrame, base: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Load a stream of mapped payments, then stop when the input is used up."""
    spark = base.sparkSession
    query = (
        mapped.writeStream.foreachBatch(upsert_batch(base, path, lambda: query_id(spark, checkpoint)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """All payments loaded by the stream, over all its runs."""
    return spark.read.parquet(f"{path}/{LOADED}").drop(RUN, BATCH)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All rows the stream could not store, with their ``error_reason``."""
    return spark.read.parquet(f"{path}/{QUARANTINE}").drop(RUN, BATCH)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Counts of every batch: read, inserted, skipped and in error."""
    return spark.read.parquet(f"{path}/{SUMMARY}")


def apply_stream(
    df: DataFrame, table: str, rules: Sequence[expect.Expectation], path: str, checkpoint: str
) -> StreamingQuery:
    """Enforce expectations on a stream, micro-batch by micro-batch.

    The rule counts of a batch are taken before anything is written, so a FAIL
    violation stops the query with that batch unpublished. Each batch owns its
    folders ``run=R/batch_id=N`` of rows and counts, which makes a replay
    overwrite instead of append and leaves the batches of other runs alone.
    """
    spark = df.sparkSession

    def enforce(batch: DataFrame, batch_id: int) -> None:
        own = f"{RUN}={query_id(spark, checkpoint)}/{BATCH}={batch_id}"
        with sinks.staged(batch, "expectation_batch") as rows:
            violated = [F.count_if(~rule.holds).alias(rule.name) for rule in rules]
            with sinks.staged(rows.agg(F.count("*").alias("input_records"), *violated), "expectation_counts") as counts:
                seen = counts.first().asDict()
                failing = [rule for rule in rules if rule.action == expect.FAIL]
                failed = expect.failed_rules({rule.name: seen[rule.name] for rule in failing}, failing)
                if failed:
                    raise expect.ExpectationFailed(table, failed)
                counts.write.mode("overwrite").parquet(f"{path}/{SUMMARY}/{own}")
            expect.keep(rows, rules).write.mode("overwrite").parquet(f"{path}/{LOADED}/{own}")

    query = (
        df.writeStream.foreachBatch(enforce)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
