"""Join shapes that stay parallel when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_split(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right`` where *either* side may have a hot key.

    Spark can split a hot key on the preserved side of an outer join only, so a
    key that is hot on the right side of a left join ends in one task. Here the
    matches are an inner join (AQE may split both sides) and the rows without a
    match are an anti join against the right side's distinct keys, which
    partial aggregation collapses before the shuffle. Where a later filter or
    inner join rejects the NULL-extended rows, Catalyst folds the second branch
    away and only the inner join remains.

    Both inputs are read twice. Use it only for a right side that is known to
    have a hot key; a plain left join serves all others.
    """
    matched = left.join(right, key, "inner")
    unmatched = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
