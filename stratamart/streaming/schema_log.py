"""Ingest that notices new columns by itself.

Each landing folder has a versioned log of its schema. The stream itself carries
the names of new files only, no column of theirs. A micro-batch looks at the
footers of its own files before it writes anything; where they hold a column the log lacks, the log gets a
wider version first, and the files are read with that. Earlier files are never opened
again, and Bronze is read with the logged schema.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratamart.sources import sinks
from stratamart.streaming.bronze import bronze_stream, widen_schema
from stratamart.streaming.payments import BATCH, RUN, query_id

# Footers of so many files are merged in one job.
FOOTERS = 10_000
_SCHEMA = "version int, schema string, added array<string>"


class SchemaConflict(ValueError):
    """A column arrives with another type than the one logged; nothing of the batch was written."""


class SchemaLog:
    """The versions of one landing folder's schema, kept at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def history(self) -> DataFrame:
        """(version, schema, added): every version, its schema as JSON and the columns that came with it."""
        if sinks.current_folder(self.spark, self.path) is None:
            return self.spark.createDataFrame([], _SCHEMA)
        return sinks.read(self.spark, self.path)

    def current(self) -> tuple[int, T.StructType]:
        """Number and schema of the newest version; (0, no columns) before the first."""
        newest = self.history().agg(F.max(F.struct("version", "schema"))).first()[0]
        if newest is None:
            return 0, T.StructType([])
        return newest["version"], T.StructType.fromJson(json.loads(newest["schema"]))

    def notice(self, seen: T.StructType) -> bool:
        """Log a wider version if ``seen`` has new columns; tells whether it had."""
        version, known = self.current()
        types = {f.name.lower(): f for f in known.fields}
        changed = [f for f in seen.fields if f.name.lower() in types and types[f.name.lower()].dataType != f.dataType]
        if changed:
            named = ", ".join(f"{f.name}: {types[f.name.lower()].dataType.simpleString()} became {f.dataType.simpleString()}" for f in changed)
            raise SchemaConflict(named)
        new = [f for f in seen.fields if f.name.lower() not in types]
        if not new:
            return False
        wider = widen_schema(known, T.StructType(new))
        entry = [(version + 1, wider.json(), [f.name for f in new])]
        # The log is one row per version, so it is written anew as a whole.
        sinks.replace(self.history().unionByName(self.spark.createDataFrame(entry, _SCHEMA)).coalesce(1), self.path)
        return True


def footer_schema(spark: SparkSession, files: Iterable[str]) -> T.StructType:
    """All columns of some Parquet files, read from their footers on the executors."""
    files = list(files)
    merged = [
        spark.read.option("mergeSchema", True).parquet(*files[at : at + FOOTERS]).schema for at in range(0, len(files), FOOTERS)
    ]
    return reduce(widen_schema, merged, T.StructType([]))


def _literal_path(encoded: str) -> str:
    """A file's path as a reader takes it: metadata give it URL-encoded, and readers expand glob characters."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(encoded))


def ingest_evolving(
    spark: SparkSession, landing: str, log: SchemaLog, target: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Ingest everything new under ``landing``, widening the schema as columns appear, then stop.

    ``max_files`` bounds a batch, and with it the file names the driver holds.
    A batch owns the folder ``run=R/batch_id=N`` and overwrites it when it is
    replayed. Columns keep their place once logged; rows of files without a
    column have NULL there, and another spelling of a name is the same column. A
    changed type stops the ingest with ``SchemaConflict`` in the message and leaves Bronze and log as they were.
    """

    def write(names: DataFrame, batch_id: int) -> None:
        files = [_literal_path(row[0]) for row in names.distinct().collect()]
        if not files:
            return
        log.notice(footer_schema(spark, files))
        _, schema = log.current()
        own = f"{RUN}={query_id(spark, checkpoint)}/{BATCH}={batch_id}"
        spark.read.schema(schema).parquet(*files).write.mode("overwrite").parquet(f"{target}/{own}")

    names = bronze_stream(spark, landing, T.StructType([]), max_files=max_files).select(F.col("_metadata.file_path"))
    query = names.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_evolved(spark: SparkSession, log: SchemaLog, target: str) -> DataFrame:
    """Bronze with the logged schema: no footer is opened to learn it."""
    _, schema = log.current()
    if not sinks.exists(spark, target):
        return spark.createDataFrame([], schema)
    placed = T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
    return spark.read.schema(placed).parquet(target).select(*[F.col(f"`{name}`") for name in schema.names])
