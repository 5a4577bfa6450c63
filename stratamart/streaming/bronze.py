"""Incremental Bronze ingest with the file source.

The checkpoint remembers which files were read and the Parquet sink keeps a
commit log, so each file is ingested once even after a failure.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BRONZE_TABLES = (
    "product", "brand", "product_category", "customer", "customer_type",
    "address", "orders", "order_item", "payment_postgres", "payment_method",
)


def bronze_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    source_format: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """New files under ``path`` as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table (file format) as an append stream."""
    return spark.readStream.table(name)


def _writer(df: DataFrame, path: str, checkpoint: str):
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def run_available_now(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Ingest everything not yet ingested, then stop; a run without new files adds no rows."""
    query = _writer(df, path, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_all(spark: SparkSession, landing: Mapping[str, T.StructType], source: str, target: str, checkpoints: str) -> None:
    """Ingest every landing folder ``source/<table>`` into ``target/<table>_bronze``.

    The streams run side by side; the call returns when all have caught up.
    """
    queries = [
        _writer(bronze_stream(spark, f"{source}/{name}", schema), f"{target}/{name}_bronze", f"{checkpoints}/{name}")
        .trigger(availableNow=True)
        .start()
        for name, schema in landing.items()
    ]
    for query in queries:
        query.awaitTermination()


def start_continuous(df: DataFrame, path: str, checkpoint: str, interval: str = "1 minute") -> StreamingQuery:
    """Keep ingesting at ``interval``; the caller stops the returned query."""
    return _writer(df, path, checkpoint).trigger(processingTime=interval).start()


def widen_schema(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` plus the columns only ``seen`` has.

    A running stream has a fixed schema: when new columns arrive, restart it on
    the same checkpoint with the widened schema, or let ``schema_log`` notice them.
    """
    names = set(known.names)
    added = [T.StructField(f.name, f.dataType, True) for f in seen.fields if f.name not in names]
    return T.StructType([*known.fields, *added])


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Bronze with the schema of its stream, so no footer is opened to learn one; absent columns are NULL."""
    return spark.read.schema(schema).parquet(path)


def latest_by_key(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The newest version of each key from an append-only change feed.

    An aggregate, so many versions of one key collapse before the shuffle.
    Versions with an equal sequence are ordered by their content.
    """
    others = [name for name in df.columns if name not in keys]
    row = F.struct(F.col(sequence).alias("_sequence"), *others)
    newest = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{name}").alias(name) for name in others]).select(*df.columns)
