"""The newest version of each key, kept up to date by a stream.

The running maximum per key lives in the state store on disk (RocksDB), so it is bounded by
neither memory nor the feed's length. A micro-batch hands over the keys it changed; they are merged
into a table of hash buckets, of which only those touched are written anew. A
manifest names the folder of every bucket and is replaced as a whole: readers
see a batch completely or not at all.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratamart.sources import sinks
from stratamart.streaming.bronze import latest_by_key

BUCKETS = 256
_BUCKET = "key_bucket"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class KeyedTable:
    """Rows of ``schema`` in folder ``path``, one per value of ``keys``; ``buckets`` stays as it was at the first write.

    One writer at a time, as one checkpoint has one running query.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.buckets = list(keys), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _manifest(self) -> dict[int, str]:
        """Bucket to folder; at most ``buckets`` entries."""
        if sinks.current_folder(self.spark, f"{self.path}/manifest") is None:
            return {}
        return {row["bucket"]: row["folder"] for row in sinks.read(self.spark, f"{self.path}/manifest").collect()}

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as of its last batch; only some ``buckets`` of it where they are given."""
        manifest = self._manifest()
        chosen = sorted(manifest if buckets is None else set(buckets) & manifest.keys())
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{manifest[b]}/{_BUCKET}={b}" for b in chosen])

    def merge(self, changes: DataFrame, sequence: str) -> list[int]:
        """Bring in newer versions; returns the buckets written. Merging the same changes again changes nothing."""
        with sinks.staged(changes, "keyed_changes") as new:
            touched = sorted(row[0] for row in new.select(self._bucket().alias(_BUCKET)).distinct().collect())
            if not touched:
                return []
            rows = latest_by_key(self.read(touched).unionByName(new), self.keys, sequence)
            folder = f"upsert-{uuid.uuid4().hex}"
            placed = rows.withColumn(_BUCKET, self._bucket()).repartition(len(touched), _BUCKET)
            placed.write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        named = self._manifest() | dict.fromkeys(touched, folder)
        entries = self.spark.createDataFrame(sorted(named.items()), "bucket int, folder string")
        sinks.replace(entries.coalesce(1), f"{self.path}/manifest")
        return touched

    def collect_garbage(self, keep: int = 2, min_age: float = sinks.DAY, abandoned_after: float = sinks.ABANDONED_AFTER) -> list[str]:
        """Remove old manifests, and the folders that none of those left names; returns the folders' names.

        A folder that no manifest has named yet may be a batch at work, so it has to be ``abandoned_after`` seconds old.
        """
        folders = {name: at for name, at in sinks.entries(self.spark, self.path).items() if name.startswith("upsert-")}
        if not folders:
            return []
        sinks.collect_garbage(self.spark, f"{self.path}/manifest", keep, min_age, abandoned_after)
        manifests = self.spark.read.schema("bucket int, folder string").parquet(f"{self.path}/manifest/version-*")
        named = {row[0] for row in manifests.select("folder").distinct().collect()}
        unused = [name for name, at in sorted(folders.items()) if name not in named and time.time() - at >= abandoned_after]
        return [name for name in unused if sinks.delete(self.spark, f"{self.path}/{name}")]


def stream_latest(feed: DataFrame, table: KeyedTable, sequence: str, checkpoint: str) -> StreamingQuery:
    """Keep ``table`` at the newest version per key of a change stream, then stop when the input is used up.

    Late and repeated versions lose against the state, equal sequences are
    ordered by content as in ``latest_by_key``. A new checkpoint on an
    existing table starts with empty state; the merge with the table keeps newer versions.
    """
    before = table.spark.conf.get(_PROVIDER, None)
    table.spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (
            latest_by_key(feed, table.keys, sequence)
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, _: table.merge(batch, sequence) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query
    finally:
        table.spark.conf.unset(_PROVIDER) if before is None else table.spark.conf.set(_PROVIDER, before)
