"""JSON columns as VARIANT: parsed once when written, paths read from the binary form.

Text that is no JSON is kept beside the variant, so nothing is lost. A path that is
absent, or whose value doesn't fit the asked type, is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INVALID = "_invalid_json"


def as_variant(df: DataFrame, column: str, invalid: str = INVALID) -> DataFrame:
    """``column`` as VARIANT; ``invalid`` holds its text where that is no JSON, else NULL."""
    if invalid in df.columns:
        raise ValueError(f"the column {invalid} is taken; name another one")
    parsed = F.try_parse_json(column)
    broken = F.when(F.col(column).isNotNull() & parsed.isNull(), F.col(column))
    return df.withColumns({invalid: broken, column: parsed})


def paths(df: DataFrame, column: str, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add a typed column per path; ``wanted`` maps names to (path, type), such as ``("$.a.b[0]", "int")``."""
    return df.withColumns({name: F.try_variant_get(column, path, kind) for name, (path, kind) in wanted.items()})


def observed_schema(df: DataFrame, column: str) -> str:
    """The merged schema of all values of a VARIANT column, as DDL."""
    return df.agg(F.schema_of_variant_agg(column).alias("schema")).first()["schema"]
