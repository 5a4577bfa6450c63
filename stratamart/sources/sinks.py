"""Table materialisation on plain Parquet folders.

A table folder holds one sub-folder per version plus an append-only ``commits``
log. Readers follow the newest commit, so a version becomes visible in one
step after it is completely written, and a failed run leaves the previous one
in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart.operators import expectations as expect
from stratamart.session import shared_folder

COMMITS = "commits"
COMMIT_SCHEMA = "sequence bigint, version string"
CLAIMS, LEASES, STAGED = "_claims", "_leases", "staged"
DAY = 86_400.0
# Seconds a staged table, or a version its writer never committed, is kept.
ABANDONED_AFTER = 7 * DAY


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/{COMMITS}")


def committed_versions(spark: SparkSession, path: str) -> DataFrame:
    """``(version)``: all versions of a table that were ever published."""
    if not exists(spark, f"{path}/{COMMITS}"):
        return spark.createDataFrame([], "version string")
    return _commits(spark, path).select("version")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> str:
    """Write the folder of a new version; ``commit`` makes it the current one."""
    version = f"version-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{version}")
    return version


def entries(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder, each with the time (seconds) it was last changed; none where there is no folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(target):
        return {}
    return {status.getPath().getName(): status.getModificationTime() / 1000 for status in filesystem.listStatus(target)}


def delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return filesystem.exists(target) and filesystem.delete(target, True)


def _next_sequence(spark: SparkSession, path: str) -> int:
    """The next commit number, claimed by creating its file: two writers never share one."""
    taken = _commits(spark, path).agg(F.max("sequence")).first()[0] if exists(spark, f"{path}/{COMMITS}") else None
    sequence = 1 if taken is None else taken + 1
    while True:
        claim = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{CLAIMS}/{sequence}")
        if claim.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(claim):
            return sequence
        sequence += 1


def commit(spark: SparkSession, path: str, version: str) -> None:
    entry = spark.range(1).select(F.lit(_next_sequence(spark, path)).cast("bigint").alias("sequence"), F.lit(version).alias("version"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the currently published version; None before the first one."""
    if not exists(spark, f"{path}/{COMMITS}"):
        return None
    return f"{path}/{_commits(spark, path).agg(F.max_by('version', 'sequence')).first()[0]}"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The currently published version of a table."""
    latest = _commits(spark, path).agg(F.max_by("version", "sequence").alias("version")).first()
    return spark.read.parquet(f"{path}/{latest['version']}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and continue from the written table.

    For results that several later steps read: they scan only the columns they
    need instead of recomputing the input, and a lost executor costs no more
    than re-reading files. Tables staged longer than ``ABANDONED_AFTER`` ago are removed.
    """
    path = f"{shared_folder(df.sparkSession)}/{STAGED}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    remove_staged(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``stage``, but the written table is removed at the end of the block."""
    path = f"{shared_folder(df.sparkSession)}/{STAGED}/{name}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """Full refresh: write a new version, then make it the current one; ``options`` go to the file writer."""
    version = write_version(df, path, partition_by, options)
    commit(df.sparkSession, path, version)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{version}")


@contextmanager
def reading(spark: SparkSession, path: str, seconds: float = DAY) -> Iterator[DataFrame]:
    """The current version, under a lease: ``collect_garbage`` leaves it until the block ends or ``seconds`` have passed.

    A reader that dies leaves a lease that runs out by itself.
    """
    folder = current_folder(spark, path)
    version = folder.rsplit("/", 1)[1]
    lease = f"{path}/{LEASES}/{version}.{int(time.time() + seconds)}.{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(lease)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(target)
    try:
        yield spark.read.parquet(folder)
    finally:
        delete(spark, lease)


def _leased(spark: SparkSession, path: str) -> set[str]:
    """Versions under a lease; leases that ran out are removed."""
    held = set()
    for name in entries(spark, f"{path}/{LEASES}"):
        version, until, _ = name.split(".")
        if float(until) >= time.time():
            held.add(version)
        else:
            delete(spark, f"{path}/{LEASES}/{name}")
    return held


def collect_garbage(
    spark: SparkSession, path: str, keep: int = 2, min_age: float = DAY, abandoned_after: float = ABANDONED_AFTER
) -> list[str]:
    """Remove the versions nobody needs any more; returns their names.

    A version goes when it is not among the newest ``keep``, was superseded
    at least ``min_age`` seconds ago and no reader holds a lease on it. Readers
    without a lease have ``min_age`` to finish. A folder that was never committed, as
    its write or its expectations failed, goes ``abandoned_after`` seconds after its last change.
    """
    if keep < 1:
        raise ValueError("the current version must be kept")
    now = time.time()
    # Folders first: one committed meanwhile is then among the commits.
    folders = {name: at for name, at in entries(spark, path).items() if name.startswith("version-")}
    commits = _commits(spark, path).orderBy(F.desc("sequence")).collect() if exists(spark, f"{path}/{COMMITS}") else []
    claimed = entries(spark, f"{path}/{CLAIMS}")
    leased = _leased(spark, path)
    old = [
        row["version"]
        for newer, row in zip(commits[keep - 1 :], commits[keep:])
        # A version is superseded when the commit after it is claimed.
        if row["version"] in folders and row["version"] not in leased and now - claimed.get(str(newer["sequence"]), now) >= min_age
    ]
    committed = {row["version"] for row in commits}
    abandoned = [name for name, at in folders.items() if name not in committed and now - at >= abandoned_after]
    return [name for name in [*old, *sorted(abandoned)] if delete(spark, f"{path}/{name}")]


def remove_staged(spark: SparkSession, min_age: float = ABANDONED_AFTER) -> list[str]:
    """Remove the staged tables written at least ``min_age`` seconds ago; returns their names."""
    folder, now = f"{shared_folder(spark)}/{STAGED}", time.time()
    old = sorted(name for name, at in entries(spark, folder).items() if now - at >= min_age)
    return [name for name in old if delete(spark, f"{folder}/{name}")]


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table hash-bucketed and sorted by ``key``.

    Two tables with the same bucketing join on the key, and aggregate by it,
    without a shuffle. Rows are spread by key first so that each bucket is one
    file instead of one per task.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def create_if_absent(df: DataFrame, path: str) -> DataFrame:
    """Write only when the table does not exist yet."""
    if exists(df.sparkSession, f"{path}/{COMMITS}"):
        return read(df.sparkSession, path)
    return replace(df, path)


def publish(df: DataFrame, observation: Observation, rules, table: str, path: str) -> dict[str, int]:
    """Write the output of ``expectations.apply`` and make it current unless a FAIL rule was violated.

    Returns the observed counts. On failure the previous version stays current,
    the unpublished one is removed and ``ExpectationFailed`` is raised.
    """
    version = write_version(df, path, ())
    counts = observation.get
    failed = expect.failed_rules(counts, rules)
    if failed:
        delete(df.sparkSession, f"{path}/{version}")
        raise expect.ExpectationFailed(table, failed)
    commit(df.sparkSession, path, version)
    return counts
