"""Consecutive numbering and exact percentiles without a single-partition sort.

Both work on an order-preserving BIGINT and cut it into 16-bit digits, so every
window partition is bounded: at most 2**16 rows (or distinct digits) per group,
whatever the size or skew of the input. Nothing depends on range sampling or
partition ids, so a recomputed task produces the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.sources import sinks

DIGIT_BITS = 16


def _before(window_keys: list[str], order: str, value: str) -> Column:
    """Sum of ``value`` over the rows strictly before this one."""
    window = Window.partitionBy(*window_keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("bigint")


def consecutive_ids(df: DataFrame, position: str, out: str, start: Column | None = None) -> DataFrame:
    """Number rows 0, 1, 2, ... (plus ``start``) in the order of ``position``.

    ``position`` is a unique, non-negative BIGINT. Rows are numbered inside
    blocks of 2**16 positions; block offsets come from two levels of block
    counts. Only the top level is a global window, over one row per 2**32
    positions.
    """
    rows = df.withColumn("_block", F.shiftright(position, DIGIT_BITS))
    blocks = rows.groupBy("_block").agg(F.count("*").alias("_n")).withColumn(
        "_super", F.shiftright("_block", DIGIT_BITS)
    )
    supers = blocks.groupBy("_super").agg(F.sum("_n").alias("_super_n"))
    supers = supers.withColumn("_one", F.lit(1)).select(
        "_super", _before(["_one"], "_super", "_super_n").alias("_super_offset")
    )
    offsets = (
        blocks.withColumn("_block_offset", _before(["_super"], "_block", "_n"))
        .join(supers, "_super")
        .select("_block", (F.col("_super_offset") + F.col("_block_offset")).alias("_offset"))
    )
    in_block = F.row_number().over(Window.partitionBy("_block").orderBy(position))
    number = F.col("_offset") + in_block - 1
    if start is not None:
        number = number + start
    return (
        rows.join(offsets, "_block")
        .withColumn(out, number.cast("bigint"))
        .drop("_block", "_offset")
    )


class RollUp:
    """Counts per value and group, from which statistics and percentiles come without the rows.

    The rows are read once, and what is written is one row per group and
    distinct value. ``ordinal`` maps a value to an order-preserving
    BIGINT, by the digits of which percentiles are located. NULL keys form a group of their own; rows
    whose value is NULL count in ``rows`` only.
    """

    def __init__(self, df: DataFrame, keys: list[str], value: str, ordinal: Column):
        self.keys, self.value = keys, value
        counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n")).withColumn("_v", ordinal.cast("bigint"))
        self.counts = sinks.stage(counts, "roll_up")

    def statistics(self) -> DataFrame:
        """Per group: rows, values, total, mean, deviation (sample), least and greatest value; one row without keys."""
        n, v = F.col("_n"), F.col(self.value)
        weight = F.when(v.isNotNull(), n)
        total = F.sum(v * (n.cast("decimal(19,0)") if _decimal(self.counts, self.value) else n))
        sums = self.counts.groupBy(*self.keys).agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("rows"), F.coalesce(F.sum(weight), F.lit(0)).alias("values"), total.alias("total"),
            F.min(self.value).alias("least"), F.max(self.value).alias("greatest"),
        )
        sums = sums.withColumn("mean", F.try_divide(F.col("total").cast("double"), F.col("values").cast("double")))
        gap = v.cast("double") - F.col("mean")
        squares = null_safe_join(self.counts, sums.select(*self.keys, "mean"), self.keys).groupBy(*self.keys).agg(F.sum(gap * gap * n).alias("_squares"))
        spread = F.when(F.col("values") > 1, F.sqrt(F.col("_squares") / (F.col("values") - 1)))
        return null_safe_join(sums, squares, self.keys).withColumn("deviation", spread).drop("_squares")

    def percentile(self, fraction: float, out: str, unit: Column | None = None) -> DataFrame:
        """The exact interpolated percentile of the ordinals per group; groups without values are absent.

        The digit that holds the wanted rank is located level by level. Digits
        in which no two ordinals differ are left out, so amounts need two levels, not four.
        """
        known = self.counts.where(F.col("_v").isNotNull())
        low, high = known.agg(F.min("_v"), F.max("_v")).first()
        digits = 0
        while low is not None and digits < 4 and low >> (DIGIT_BITS * digits) != high >> (DIGIT_BITS * digits):
            digits += 1
        levels = {0: known.select(*self.keys, F.col("_v").alias("_d0"), "_n")}
        for k in range(1, digits):
            finer = levels[k - 1].withColumn(f"_d{k}", F.shiftright(f"_d{k - 1}", DIGIT_BITS))
            levels[k] = finer.groupBy(*self.keys, f"_d{k}").agg(F.sum("_n").alias("_n"))
        totals = levels[max(levels)].groupBy(*self.keys).agg(F.sum("_n").alias("_total"))
        # Without values there is no group, not one empty one.
        rank = (F.col("_total") - 1) * F.lit(fraction)
        end = lambda name, at: F.struct(F.lit(name).alias("end"), at.cast("bigint").alias("rank"))
        wanted = totals.where(F.col("_total").isNotNull()).select(
            *self.keys, (rank - F.floor(rank)).alias("_weight"), F.explode(F.array(end("low", F.floor(rank)), end("high", F.ceil(rank)))).alias("_want")
        )
        found = wanted.select(*self.keys, "_weight", F.col("_want.end").alias("_end"), F.col("_want.rank").alias("_rank"))
        for k in range(max(levels), -1, -1):
            found = self._narrow(found, levels[k], k, k < max(levels))
        pick = lambda name: F.max(F.when(F.col("_end") == name, F.col("_d0")))
        value = pick("low") + (pick("high") - pick("low")) * F.max("_weight")
        result = found.groupBy(*self.keys).agg((value if unit is None else value * unit).cast("double").alias(out))
        return result if self.keys else result.where(F.col(out).isNotNull())

    def _narrow(self, wanted: DataFrame, level: DataFrame, k: int, has_parent: bool) -> DataFrame:
        """From the digits above level ``k`` to the digit of level ``k`` that holds the rank."""
        parent, digit = f"_d{k + 1}", f"_d{k}"
        if has_parent:
            level = level.withColumn(parent, F.shiftright(digit, DIGIT_BITS))
        on = [*self.keys, parent] if has_parent else self.keys
        # Without keys there are two wanted rows; the hint keeps that from becoming a product of partitions.
        joined = null_safe_join(level, wanted if self.keys else F.broadcast(wanted), on)
        located = joined.withColumn("_skip", _before([*on, "_end"], digit, "_n")).where(
            (F.col("_skip") <= F.col("_rank")) & (F.col("_rank") < F.col("_skip") + F.col("_n"))
        )
        return located.select(*self.keys, "_weight", "_end", (F.col("_rank") - F.col("_skip")).alias("_rank"), digit)


def _decimal(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.DecimalType)

def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All columns of both, joined where the keys are equal or both NULL; every pair without keys."""
    renamed = right.select(*[F.col(name).alias(f"_right_{name}") if name in keys else F.col(name) for name in right.columns])
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(renamed if keys else F.broadcast(renamed), same).drop(*[f"_right_{name}" for name in keys])


def exact_percentile(
    df: DataFrame, keys: list[str], ordinal: str, fraction: float, out: str, unit: Column | None = None
) -> DataFrame:
    """Exact interpolated percentile of a BIGINT ``ordinal`` per ``keys``.

    Built-in exact percentiles hold every distinct value of a group in one
    task; this rolls values up and locates the rank by digits. ``unit`` scales the result
    (for example cents to currency). NULL ordinals are ignored; ``keys`` may be
    empty, and groups without values are absent.
    """
    return RollUp(df.where(F.col(ordinal).isNotNull()), keys, ordinal, F.col(ordinal)).percentile(fraction, out, unit)
