"""Payment export documents: ``{"data": [{payment}, ...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.sources import sinks

FIELDS = "id string, amount_received bigint, currency string, created bigint, status string, customer string, description string"


def explode_documents(documents: DataFrame) -> DataFrame:
    """``(index, raw)``: one row per payment, the element kept as JSON text.

    A document without ``data`` contributes no rows.
    """
    data = F.coalesce("data", F.array().cast("array<string>"))
    return documents.select("*", F.posexplode(data).alias("index", "raw")).drop("data")


def parse_payments(raw: DataFrame, keep_raw: bool = True) -> DataFrame:
    """Typed columns from ``raw``; ``metadata`` stays JSON text, ``present_keys`` lists the keys given.

    The keys tell an absent field, which has a default, from an explicit null,
    which is an error. A value of the wrong type is NULL and leaves the other
    fields intact.

    A stream is spread before it is parsed: a micro-batch is often a single file of
    one row group, which one task would parse alone.
    """
    if raw.isStreaming:
        # By position too, where there is one, so that a much-repeated text does not fill one task.
        raw = raw.repartition(*[name for name in ("raw", "position") if name in raw.columns])
    others = [name for name in raw.columns if name != "raw"]
    parsed = raw.select(
        *others,
        F.from_json("raw", f"{FIELDS}, metadata string").alias("_payment"),
        F.json_object_keys("raw").alias("present_keys"),
        "raw",
    ).select(*others, "_payment.*", "present_keys", "raw")
    return parsed if keep_raw else parsed.drop("raw")


def read_documents(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``(document, block, line, data, error)``: one row per document, unreadable ones included.

    ``error`` tells a broken document and one whose ``data`` is no array from
    one without ``data``, which is allowed and has no payments. ``document``,
    ``block`` and ``line`` order the documents; the result is written once, so
    that they stay what they are.
    """
    text = (
        spark.read.option("wholetext", multiline)
        .text(path)
        .select(F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("block"), "value")
        .withColumn("line", F.monotonically_increasing_id())
        .where(F.trim("value") != "")
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = F.from_json("value", "data array<string>, broken string", options)
    error = F.when(F.json_object_keys("value").isNull(), "not a JSON object").when(
        F.col("parsed.broken").isNotNull(), "broken, or data is not an array"
    )
    read = text.withColumn("parsed", parsed).select("document", "block", "line", "parsed.data", error.alias("error"))
    return sinks.stage(read, "export_documents")


def _split_offsets(sized: DataFrame) -> DataFrame:
    """(document, block, before_split): how many payments earlier file splits hold, in path order.

    Splits are written once in sorted pieces of equal size. Inside a piece a
    running sum counts; the totals of the pieces, one number a shuffle
    partition, are added up on the driver.
    """
    spark = sized.sparkSession
    held = sized.groupBy("document", "block").agg(F.sum("elements").alias("held"))
    pieces = held.repartitionByRange("document", "block").withColumn("piece", F.spark_partition_id())
    splits = sinks.stage(pieces, "export_splits")
    totals = splits.groupBy("piece").agg(F.sum("held").alias("held")).collect()
    before, offsets = 0, []
    for piece, n in sorted((row["piece"], row["held"]) for row in totals):
        offsets.append((piece, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(offsets, "piece int, piece_offset bigint"))
    earlier = Window.partitionBy("piece").orderBy("document", "block").rowsBetween(Window.unboundedPreceding, -1)
    inside = splits.withColumn("inside", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    return inside.join(offsets, "piece").select("document", "block", (F.col("piece_offset") + F.col("inside")).alias("before_split"))


def positioned_payments(documents: DataFrame, keep_raw: bool = True) -> DataFrame:
    """Payments of the readable ``documents`` with ``position``: consecutive, by file, place in it and place in the document.

    A position is what earlier file splits hold, earlier documents of the
    split, and the index in the document. No step gathers all splits in one task.
    """
    sized = documents.where(F.col("error").isNull()).withColumn("elements", F.coalesce(F.size("data"), F.lit(0)).cast("bigint"))
    within = Window.partitionBy("document", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("before", F.coalesce(F.sum("elements").over(within), F.lit(0))).join(_split_offsets(sized), ["document", "block"])
    rows = explode_documents(placed.select("document", "data", (F.col("before_split") + F.col("before")).alias("start")))
    rows = rows.withColumn("position", F.col("start") + F.col("index")).drop("start")
    return parse_payments(rows, keep_raw)


def read_payment_export(
    spark: SparkSession, path: str, multiline: bool = True, keep_raw: bool = True
) -> DataFrame:
    """Payments of one or many export documents, in file order.

    ``multiline``: every file is one document, read by one task. For large
    exports use one document per line (``multiline=False``), which splits.
    ``document`` and ``index`` give the place inside the export. Documents that
    cannot be read raise; ``read_documents`` returns them as rows instead, and
    ``positioned_payments`` adds the order that the loader needs.
    """
    documents = (
        spark.read.schema("data array<string>")
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .json(path)
        .select("data", F.col("_metadata.file_path").alias("document"))
    )
    return parse_payments(explode_documents(documents), keep_raw)
