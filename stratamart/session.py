"""Session construction and the runtime SQL settings the plans rely on."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings only: safe to apply to a session somebody else created.
# forceOptimizeSkewedJoin lets AQE split a hot key even where the join output
# feeds an aggregation on the same key (it then pays one extra shuffle).
# The advisory size is of compressed rows, which take up to 30 times that in the sorts and hash
# maps of a join that feeds aggregates; with the default of 64 MB four such tasks fill an executor.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "stratamart", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI semantics; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        # Call-site capture per column expression costs more than planning does.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **RUNTIME_SETTINGS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stratamart-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves local masters, whose driver
    and executors are one process; anything else is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()
