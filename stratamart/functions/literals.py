"""Small fixed tables as plans that need no Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A DataFrame of literal rows."""
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
