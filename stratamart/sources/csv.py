"""CSV folders as Bronze tables, with malformed rows kept instead of failing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """Column types inferred from the files (reads them once)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path).schema


def read_csv_bronze(
    spark: SparkSession, path: str, schema: T.StructType | None = None, rescued: str | None = RESCUED
) -> DataFrame:
    """A CSV file or folder with header as a Bronze table.

    Without ``schema`` the types are inferred first. A row that does not fit the
    schema is kept: cells that parse keep their values, the others are NULL and
    the raw line lands in ``rescued``. Pass a schema in production, both to save
    the inference pass and because inference widens a column to STRING when one
    cell does not parse, leaving nothing to rescue.
    """
    schema = schema or infer_schema(spark, path)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if rescued is not None:
        schema = T.StructType([*schema.fields, T.StructField(rescued, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", rescued)
    return reader.schema(schema).csv(path)


def read_csv_cells(spark: SparkSession, path: str, schema: T.StructType, rescued: str = RESCUED) -> DataFrame:
    """As ``read_csv_bronze`` with a schema, but cell by cell: good cells are typed, misfits are rescued by name.

    ``rescued`` is a JSON object of the cells that don't fit their column, by
    column name and as they were written, and NULL where all fit. An empty cell
    is NULL and fits. A line with too few or too many cells keeps those that
    are in place and lands there whole under the name ``rescued`` itself.
    """
    if rescued in schema.names:
        raise ValueError(f"the column {rescued} is taken; name another one")
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*schema.names, rescued]])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescued)
    text = {name: F.col(f"`{name}`") for name in schema.names}
    typed = {field.name: text[field.name].try_cast(field.dataType) for field in schema.fields}
    misfits = [(name, text[name].isNotNull() & typed[name].isNull()) for name in schema.names]
    misfits.append((rescued, F.col(rescued).isNotNull()))
    cells = F.array(*[F.when(bad, F.struct(F.lit(name).alias("name"), F.col(f"`{name}`").alias("cell"))) for name, bad in misfits])
    found = F.array_compact(cells)
    return reader.schema(texts).csv(path).select(
        *[typed[name].alias(name) for name in schema.names],
        F.when(F.size(found) > 0, F.to_json(F.map_from_entries(found))).alias(rescued),
    )


def bronze_name(file_name: str) -> str:
    """Bronze table name of a CSV file: its stem plus ``_bronze``."""
    stem = file_name.rstrip("/").rsplit("/", 1)[-1]
    return stem.removesuffix(".csv") + "_bronze"


def read_csv_folder(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """One Bronze table per ``*.csv`` entry (file or folder of parts) in ``folder``.

    The listing goes through Spark's file source, so any filesystem works.
    """
    schemas = schemas or {}
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    paths = sorted(
        status.getPath().toString()
        for status in filesystem.listStatus(hadoop_path)
        if status.getPath().getName().endswith(".csv")
    )
    return {bronze_name(path): read_csv_bronze(spark, path, schemas.get(bronze_name(path))) for path in paths}
