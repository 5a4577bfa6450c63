"""Shared pieces of the corpus operators: tables, staging, words, row packing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space; bytes.split() cuts the same way.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


# Rows that go to Python at once. Texts are long, and a batch lies in memory on both sides.
BATCH_ROWS = 1_000


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most ``BATCH_ROWS`` rows from now on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, one is made and set (local masters only)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="stratamart-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str, compression: str = "zstd", narrow: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``narrow`` tables hold ids only, a small share of the corpus; they come from an
    eighth of the shuffle partitions, so that they are not scattered over tiny files.
    """
    spark = df.sparkSession
    bound_batches(spark)
    if narrow:
        df = df.coalesce(max(8, partitions(spark) // 8))
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores appended as it takes to differ from every column of ``docs``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
