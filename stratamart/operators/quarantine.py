"""Payment loads that keep their bad records, and the replay of repaired ones.

The quarantine folder holds ``entries``, one row per distinct bad record under the
SHA-256 of its text, and ``replayed``, the keys of repaired records together with the
table version that contains them. A key counts as replayed only if that version was
committed: a run that dies in between leaves the entry open, one that is repeated loads
nothing twice, records without id included.

Loads and replays of one table and quarantine must not run at the same time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators import ingest
from stratamart.sources import payment_export, sinks

ENTRY = "content_key string, position bigint, error_reason string, raw string"
MARK = "content_key string, version string"


class Quarantine:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _table(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        if not sinks.exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def entries(self) -> DataFrame:
        """Every bad record met so far, once."""
        return self._table("entries", ENTRY)

    def open(self, table: str) -> DataFrame:
        """Entries of which no repaired form has been loaded into ``table``."""
        done = self._table("replayed", MARK).join(sinks.committed_versions(self.spark, table), "version", "left_semi")
        return self.entries().join(done, "content_key", "left_anti")

    def _keep(self, classified: DataFrame) -> None:
        """Append bad records whose text is not there yet, at positions behind all earlier ones."""
        known = self.entries()
        behind = known.agg((F.coalesce(F.max("position"), F.lit(-1)) + 1).alias("behind"))
        bad = classified.where(F.col("load_status") == ingest.ERROR).withColumn("content_key", F.sha2("raw", 256))
        first = F.min(F.struct("position", "error_reason", "raw")).alias("first")
        new = bad.groupBy("content_key").agg(first).join(known, "content_key", "left_anti").crossJoin(F.broadcast(behind))
        placed = new.select("content_key", (F.col("first.position") + F.col("behind")).alias("position"), "first.error_reason", "first.raw")
        # The folder that is appended to is also read, so the new rows are written elsewhere first.
        with sinks.staged(placed, "quarantined") as rows:
            rows.write.mode("append").parquet(f"{self.path}/entries")

    def _publish(self, classified: DataFrame, table: str, marks: DataFrame | None = None) -> DataFrame:
        target = ingest.evolve(sinks.read(self.spark, table))
        accepted = classified.where(F.col("load_status") == ingest.INSERTED)
        loaded = ingest.append_rows(target, ingest.assign_ids(accepted, target))
        version = sinks.write_version(loaded, table)
        if marks is not None:
            marks.select("content_key", F.lit(version).alias("version")).write.mode("append").parquet(f"{self.path}/replayed")
        sinks.commit(self.spark, table, version)
        return sinks.read(self.spark, table)

    def load(self, mapped: DataFrame, table: str) -> DataFrame:
        """Load a mapped batch with its ``raw`` texts into the versioned ``table``; bad records go to the quarantine."""
        target = ingest.evolve(sinks.read(self.spark, table))
        with sinks.staged(ingest.classify(mapped, target), "classified") as classified:
            self._keep(classified)
            return self._publish(classified, table)

    def replay(self, repaired: DataFrame, table: str) -> DataFrame:
        """Load ``repaired(content_key, raw)`` as far as their entries are open, in the order of the bad records.

        A repaired record that is still bad leaves its entry open; one whose id is loaded already closes it. Of several repairs
        of one entry the least text is taken.
        """
        texts = repaired.groupBy("content_key").agg(F.min("raw").alias("raw"))
        fixed = self.open(table).select("content_key", "position").join(texts, "content_key")
        with sinks.staged(fixed, "repaired") as due:
            target = ingest.evolve(sinks.read(self.spark, table))
            mapped = ingest.map_payments(payment_export.parse_payments(due.select("position", "raw")))
            with sinks.staged(ingest.classify(mapped, target), "classified") as classified:
                closed = classified.where(F.col("load_status") != ingest.ERROR).select("position")
                return self._publish(classified, table, due.join(closed, "position"))
