"""An index of the ids a table holds, so that a load never scans the table.

Ids lie in hash buckets, which are partitions of the stored index, and every file
carries a Bloom filter of its ids. A lookup of few ids becomes literals: only their buckets are listed, and
inside them only row groups whose filter admits an id are read. A larger
lookup is joined on (bucket, id), and dynamic partition pruning leaves the buckets no id falls into.

Each id is stored with the run and batch that loaded it, so a replayed batch can
look up what all *others* loaded. Batches append; ``compact`` rewrites the buckets as
a new version, one file each. Adding an id twice does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.sources import sinks

ID = "stripe_payment_id"
BUCKETS = 256
FEW = 100
# Larger IN lists are not pushed down to the files as single values.
_PUSHED = 10
_SCHEMA = f"{ID} string, run string, batch_id bigint, id_bucket int"
_OPTIONS = {
    f"parquet.bloom.filter.enabled#{ID}": "true",
    # The filter grows with the ids of the file, up to this size.
    f"parquet.bloom.filter.adaptive.enabled#{ID}": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}


class KnownIds:
    """The index in folder ``path``; ``buckets`` is part of the folder's name, so another number is another index."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, f"{path}/buckets-{buckets}", buckets

    def bucket(self, id_: Column) -> Column:
        return F.pmod(F.xxhash64(id_), F.lit(self.buckets)).cast("int")

    def table(self) -> DataFrame:
        """(stripe_payment_id, run, batch_id, id_bucket) of everything added."""
        folder = sinks.current_folder(self.spark, self.path)
        if folder is None:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(folder)

    def add(self, rows: DataFrame) -> None:
        """Append (stripe_payment_id, run, batch_id); rows without id are left out."""
        placed = rows.where(F.col(ID).isNotNull()).select(ID, "run", F.col("batch_id").cast("bigint").alias("batch_id"), self.bucket(F.col(ID)).alias("id_bucket"))
        if sinks.current_folder(self.spark, self.path) is None:
            sinks.replace(self.spark.createDataFrame([], _SCHEMA), self.path, ["id_bucket"], _OPTIONS)
        writer = placed.repartition("id_bucket").write.mode("append").partitionBy("id_bucket").options(**_OPTIONS)
        writer.parquet(sinks.current_folder(self.spark, self.path))

    def sync(self, rows: DataFrame) -> None:
        """Add those of ``rows`` that are not there; run once at a start, for what others loaded or a crash left out."""
        missing = rows.join(self.table().select(ID, "run", "batch_id"), [ID, "run", "batch_id"], "left_anti")
        with sinks.staged(missing.distinct(), "missing_ids") as found:
            if not found.isEmpty():
                self.add(found)

    def matching(self, ids: DataFrame, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """Those of ``ids`` (one column, without NULLs) that are known; loads of (``run``, ``batch_id``) do not count."""
        known = self.table()
        if run is not None:
            known = known.where((F.col("run") != run) | (F.col("batch_id") != batch_id))
        wanted = ids.select(ID, self.bucket(F.col(ID)).alias("id_bucket"))
        few = wanted.limit(FEW + 1).collect()
        if len(few) <= FEW:
            values = sorted({row[ID] for row in few})
            one_of = F.lit(False)
            for at in range(0, len(values), _PUSHED):
                one_of = one_of | F.col(ID).isin(values[at : at + _PUSHED])
            return known.where(F.col("id_bucket").isin(sorted({row["id_bucket"] for row in few})) & one_of).select(ID)
        # The comparison is always true; it tells the optimizer that the ids select buckets.
        return known.join(wanted.where(F.col("id_bucket") < self.buckets), ["id_bucket", ID], "left_semi").select(ID)

    def compact(self) -> None:
        """Rewrite the index with one file a bucket."""
        whole = self.table().distinct().repartition("id_bucket").sortWithinPartitions(ID)
        sinks.replace(whole, self.path, ["id_bucket"], _OPTIONS)
