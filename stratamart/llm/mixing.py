"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Every source gets a share of the total size in proportion to its weight, but at
most ``max_epochs`` times its own size; what a clamped source leaves over goes to
the others by weight until no source is above its clamp. A source is then taken
``floor(target / size)`` whole times, and once more for the documents with the
smallest seeded keys until the remaining fraction is reached.

The cut that ends the fractional repetition is found by radix selection: sizes are
summed per (source, first three hex digits of the key), the digit group in which
the fraction ends is opened by its next three digits, and only what is left there
(one key in 2**24) is ordered. A hot source therefore never meets in one task. The
table of sources (one row each) is the only thing ordered globally.

Defined cases: a null text or one without words has size 0, takes 0 and is never repeated by the fraction; a null
source is a source of its own, ordered last; rows with the same id share one key and
are kept or left together; an empty table gives an empty result; further columns pass
through, those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import n_words, stage, table, unused

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
_DIGITS = 3


def _key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Water-filling over a table (source, source_size): adds target, whole and want (the fractional rest)."""
    big = "decimal(38,0)"
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("rank"))
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_epochs).cast(big)
    ranked = (
        sizes.withColumn("rank", F.row_number().over(order))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything).cast(big))
    )
    # With all earlier sources clamped: what is free, and the weight it is shared by.
    open_ = ranked.withColumn(
        "free", F.col("total") - F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast(big))
    ).withColumn("open_weight", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    clamped = open_.withColumn(
        "clamped", F.col("free").cast(big) * F.col("weight") > F.col("cap") * F.col("open_weight")
    )
    level = F.min(F.when(~F.col("clamped"), F.struct(F.col("source_size") / F.col("weight"), "rank", "free", "open_weight"))).over(everything)
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
        (F.col("level.free").cast("double") * F.col("weight")) / F.col("level.open_weight").cast("double")
    )
    return (
        clamped.withColumn("level", level)
        .select("source", "source_size", target.alias("target"))
        .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long"))
        .withColumn("want", F.col("target") - F.col("whole") * F.col("source_size"))
    )


def _open_digits(rows: DataFrame, sources: DataFrame, start: int, width: int | None) -> DataFrame:
    """For each source, the digit group in which the fraction ends, or (``width`` None) the last key inside it."""
    digits = F.col("key") if width is None else F.substring("key", start, width)
    sums = rows.groupBy("source", digits.alias("digits")).agg(F.sum("size").alias("group_size"))
    order = Window.partitionBy("source").orderBy("digits")
    s = sources.select(F.col("source").alias("s"), "want", "skip")
    placed = sums.withColumn("upto", F.sum("group_size").over(order)).join(s, F.col("source").eqNullSafe(F.col("s")))
    upto, before = F.col("skip") + F.col("upto"), F.col("skip") + F.col("upto") - F.col("group_size")
    if width is None:
        fits = upto + before <= 2 * F.col("want")
        return placed.filter(fits).groupBy("s").agg(F.max("digits").alias("digits"))
    return placed.filter((before <= F.col("want")) & (F.col("want") < upto)).select("s", "digits", before.alias("next_skip"))


def mixing_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """One row per source: source_size, target, whole repetitions, and the last key of the fractional one."""
    rows = stage(docs.select("source", _key(F.col("doc_id"), seed).alias("key"), n_words(F.col("text")).alias("size")), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stage(source_targets(sources, weights, max_epochs).withColumn("skip", F.lit(0).cast("long")).withColumn("prefix", F.lit("")), "mix-sources")

    rows = rows.filter("size > 0")
    for start in (1, 1 + _DIGITS):
        found = _open_digits(rows, plan, start, _DIGITS)
        opened = plan.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
        plan = stage(
            opened.select(
                "source", "source_size", "target", "whole", "want", F.coalesce("next_skip", "skip").alias("skip"),
                F.concat("prefix", F.coalesce("digits", F.lit(""))).alias("prefix"),
            ),
            "mix-level",
        )
        p = plan.select(F.col("source").alias("p"), "prefix")
        rows = rows.join(p, F.col("source").eqNullSafe(F.col("p")) & F.col("key").startswith(F.col("prefix"))).select("source", "key", "size")
    last = _open_digits(rows, plan, 1, None)
    return plan.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("digits", "prefix").alias("last_key")
    )


def _mixed(docs: DataFrame, names: list[str], weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies under ``names``, none of which it has."""
    plan = stage(mixing_plan(docs, weights, max_epochs, seed), "mix-plan")
    size, packed = names[0], unused(docs, "plan")[0]
    # One struct holds the plan, so that no column of the documents meets a name of it.
    plan = plan.select(F.struct(*plan.columns).alias(packed))
    of = lambda name: F.col(f"{packed}.{name}")
    extra = ((F.col(size) > 0) & (_key(F.col("doc_id"), seed) <= of("last_key"))).cast("long")
    return docs.withColumn(size, n_words(F.col("text"))).join(plan, F.col("source").eqNullSafe(of("source"))).select(
        *docs.columns, size, of("source_size").alias(names[1]), of("target").alias(names[2]),
        F.least(of("whole") + extra, F.lit(max_epochs)).cast("long").alias(names[3]),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies (columns of these names are replaced): how often the mix repeats each document."""
    names = ["size", "source_size", "target", "copies"]
    return _mixed(docs.select(*[c for c in docs.columns if c.lower() not in names]), names, weights, max_epochs, seed)


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with ``repetition`` 1, 2, ...

    All columns of ``docs`` stay as they are; if one is called repetition, the new one is ``repetition_``.
    """
    names = unused(docs, "size", "source_size", "target", "copies", "repetition")
    copies, repetition = names[3:]
    repeats = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))
    return _mixed(docs, names[:4], **how).filter(F.col(copies) > 0).select(*docs.columns, repeats.alias(repetition))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
             3 * source_size AS cap, sum(source_size) OVER () AS total FROM r),
o AS (SELECT *,
        total - coalesce(sum(cap) OVER (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
        sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
      FROM w),
c AS (SELECT *, free * weight > cap * open_weight AS clamped FROM o),
l AS (SELECT free AS lf, open_weight AS lw FROM c WHERE NOT clamped ORDER BY source_size::DOUBLE / weight, rank LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE lf::DOUBLE * weight / lw::DOUBLE END AS target FROM c, l),
p AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM t),
k AS (SELECT d.doc_id, d.source, d.size, p.source_size, p.target, p.whole,
        target - whole * source_size AS want,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        sum(d.size) OVER (PARTITION BY d.source, key) AS peers
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
f AS (SELECT *, least(whole + CASE WHEN size > 0 AND 2 * upto - peers <= 2 * want THEN 1 ELSE 0 END, 3) AS copies FROM k)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, (copies * size)::BIGINT AS taken, source, copies::BIGINT AS copies FROM f
"""
