"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

A vector is padded to a power of two, and for each table rotated by three rounds of seeded
signs and a fast Hadamard transform; its hash is the coordinate of largest size with its sign,
for several rotations together (more for more vectors, see :func:`settings`). A vector is stored under its own hash in each table, and
asks also the ``PROBES`` buckets that change the closest second choices. The number of tables follows from the
rate at which two vectors at the threshold meet in one table, which depends on the dimension and the hashes.

Equal vectors are one class. What a bucket's members ask and store meet in one group; a
group above ``GROUP`` members is cut into blocks, one task for each pair of blocks. Cosines
are computed in double precision, and a pair counts in the first table in which it meets,
which each vector's hashes tell, so links are counted once without writing pairs. A group
gives back the number of links of its vectors and a spanning forest.

Recall is measured in tests/llm against brute force and at the threshold (0.95 is asked for, ``RECALL`` aimed at).

Defined cases: a vector that is null, empty, zero or holds null or non-finite components
links with nothing and is its own component; vectors of another length than the most
frequent one are compared among their own length; repeated rows count as copies; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage, table
from stratamart.llm.graph import components, local_roots
from stratamart.llm.hashing import mix

COSINE = 0.9
# The share of pairs at the threshold itself that shall meet; closer pairs meet more often.
RECALL = 0.98
MAX_HASHES = 6
PROBES = 3
GROUP = 800
SEED = 11
_SAMPLES = 8_000
_PAIR_BUCKETS = 12_800_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def _buckets(rotated: Iterable[np.ndarray], seed: int, probes: int, length: int = 0) -> np.ndarray:
    """(vectors, 1 + probes) bucket numbers of one table, from the vectors under each of its rotations."""
    best, other, loss = [], [], []
    for x in rotated:
        n, d = x.shape
        rows = np.arange(n)
        size = np.abs(x)
        near = np.argpartition(-size, min(probes, d - 1), axis=1)[:, : probes + 1]
        near = near[rows[:, None], np.argsort(-size[rows[:, None], near], axis=1)]
        sign = x[rows[:, None], near] < 0
        vertex = (2 * near + sign).astype(np.uint64)
        best.append(vertex[:, 0])
        other.append(vertex[:, 1:])
        loss.append(size[rows[:, None], near[:, :1]] - size[rows[:, None], near[:, 1:]])

    def bucket(vertices: list[np.ndarray]) -> np.ndarray:
        code = np.full(n, seed, np.uint64)
        for v in vertices:
            code = mix(code * np.uint64(0x9E3779B97F4A7C15) + v + np.uint64(1))
        return code ^ np.uint64(length)

    out = np.zeros((n, 1 + probes), np.uint64)
    out[:, 0] = bucket(best)
    # The cheapest single changes over all hashes of the table.
    choices = [bucket([*best[:h], other[h][:, k], *best[h + 1 :]]) for h in range(len(best)) for k in range(other[h].shape[1])]
    if choices and probes:
        cost = np.concatenate(loss, axis=1)
        cheap = np.argsort(cost, axis=1)[:, :probes]
        out[:, 1 : 1 + cheap.shape[1]] = np.stack(choices, axis=1)[rows[:, None], cheap]
    return out


def _padded(length: int) -> int:
    return 1 << max(1, (length - 1).bit_length())


def codes(vectors: np.ndarray, tables: int, hashes: int, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """(vectors, tables, 1 + probes) bucket numbers: a vector's own bucket, then those it asks as well."""
    n, length = vectors.shape
    d = _padded(length)
    padded = np.zeros((n, d))
    padded[:, :length] = vectors
    rng = np.random.default_rng([seed, length])
    out = np.zeros((n, tables, 1 + probes), np.uint64)

    def rotated() -> Iterator[np.ndarray]:
        for _ in range(hashes):
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], d))
            yield x

    for t in range(tables):
        out[:, t] = _buckets(rotated(), t + 1, probes, length)
    return out


@lru_cache(maxsize=64)
def meeting_rate(length: int, hashes: int, cosine: float, probes: int = PROBES) -> float:
    """The share of pairs at ``cosine`` that meet in one table, from a seeded sample of randomly rotated pairs."""
    d, met = _padded(length), 0
    rng = np.random.default_rng([SEED, d, hashes])
    for _ in range(_SAMPLES // 250):
        x = rng.normal(size=(hashes, 250, d))
        y = cosine * x + math.sqrt(max(0.0, 1 - cosine**2)) * rng.normal(size=x.shape)
        a, b = _buckets(x, 1, probes), _buckets(y, 1, probes)
        met += int(((a == b[:, :1]) | (b == a[:, :1])).any(1).sum())
    return met / (_SAMPLES // 250 * 250)


def _classes(vectors: DataFrame) -> DataFrame:
    """(key, vector, vec_id, copies): one row per different usable vector; the key is the md5 of its components."""
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    as_double = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    # -0.0 and 0.0 are one component.
    flat = as_double.filter(usable).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    keyed = flat.withColumn("key", F.unhex(F.md5(F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","))))
    return keyed.groupBy("key").agg(
        F.first("embedding").alias("vector"), F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")
    )


def _hashed(classes: DataFrame, tables: int, hashes: int) -> DataFrame:
    """``classes`` with their bucket lists: for each table the own bucket and then those asked."""
    names = "key binary, vector array<double>, vec_id long, copies long, buckets array<long>"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            lists: list = [None] * len(rows)
            for length in {len(r) for r in rows}:
                own = [i for i, r in enumerate(rows) if len(r) == length]
                found = codes(_units(np.array([rows[i] for i in own], float)), tables, hashes).view(np.int64)
                for i, row in zip(own, found.reshape(len(own), -1), strict=True):
                    lists[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], [*batch.schema.names, "buckets"])

    return stage(classes.mapInArrow(place, names), "hashed")


def settings(n: int, length: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(tables, hashes): so many hashes that unlike vectors seldom meet among n, and tables that reach the recall with them."""
    d = _padded(length)
    hashes = 1
    while (2 * d) ** hashes < 512 * n and hashes < MAX_HASHES:
        hashes += 1
    rate = min(max(meeting_rate(length, hashes, cosine), 1 / _SAMPLES), 1 - 1e-9)
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-rate))), hashes


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _first_meeting(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """For pairs of bucket lists (pairs, tables, 1 + probes), the smallest (table, bucket) in which both meet."""
    asked = (mine == theirs[:, :, :1]) | (theirs == mine[:, :, :1])
    table_ = asked.any(2).argmax(1)
    rows = np.arange(len(mine))
    m, t = mine[rows, table_], theirs[rows, table_]
    # They may meet in each one's own bucket: the smaller counts.
    big = np.int64(2**63 - 1)
    in_theirs = np.where((m == t[:, :1]).any(1), t[:, 0], big)
    in_mine = np.where((t == m[:, :1]).any(1), m[:, 0], big)
    return np.minimum(in_theirs, in_mine)


def _verify(bucket: int, left: int, right: int, key: list[bytes], block: np.ndarray, own: np.ndarray, copies: np.ndarray, vectors: np.ndarray, buckets: np.ndarray, cosine: float) -> list[tuple]:
    x = _units(vectors)
    n, width = len(x), 1 + PROBES
    buckets = buckets.reshape(n, -1, width)
    links, xs, ys = np.zeros(n, np.int64), [], []
    for at in range(0, n, 512):
        here = slice(at, at + 512)
        near = x[here] @ x.T >= cosine
        near &= own[here, None] | own[None, :]
        near &= (block[here, None] != block[None, :]) | (left == right)
        a, b = np.nonzero(near)
        a = a + at
        keep = a != b
        a, b = a[keep], b[keep]
        step = max(1, _PAIR_BUCKETS // buckets[0].size)
        for k in range(0, len(a), step):
            i, j = a[k : k + step], b[k : k + step]
            here_first = _first_meeting(buckets[i], buckets[j]) == bucket
            i, j = i[here_first], j[here_first]
            np.add.at(links, i, copies[j])
            xs.append(i)
            ys.append(j)
    if not xs:
        return []
    root = local_roots(n, np.concatenate(xs), np.concatenate(ys))
    return [(key[i], key[r], int(links[i])) for i, r in enumerate(root) if links[i]]


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding)."""
    classes = stage(_classes(vectors), "vectors")
    n, length = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    tables, hashes = settings(n, length or 1, cosine)
    classes = _hashed(classes, tables, hashes)
    placed = classes.select("key", F.posexplode("buckets").alias("at", "bucket")).select("key", "bucket", (F.col("at") % (1 + PROBES) == 0).alias("own"))
    # Only buckets in which somebody is stored and somebody else is stored or asks; vectors are sent to no others.
    live = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("stored")).filter("n > 1 AND stored")
    live = live.select("bucket", F.ceil(F.col("n") / GROUP).cast("int").alias("blocks"))
    placed = placed.join(live, "bucket").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.join(classes.select("key", "copies", "vector", "buckets"), "key").select("*", other.alias("other")).select(
        "bucket", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "own", "key", "copies", "vector", "buckets"
    )

    def verify(part: tuple, group: pa.Table) -> pa.Table:
        bucket, left, right = (p.as_py() for p in part)
        group = group.take(pa.array(np.argsort(np.array(group["key"].to_pylist(), dtype=object), kind="stable")))
        n = group.num_rows
        flat = lambda c: group[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        lengths = {len(v) for v in group["vector"].to_pylist()} if group["vector"].combine_chunks().flatten().__len__() % n else {0}
        out = [] if n < 2 or len(lengths) > 1 else _verify(
            bucket, left, right, group["key"].to_pylist(), group["block"].to_numpy(), np.array(group["own"].to_pylist(), bool), group["copies"].to_numpy(), flat("vector"), flat("buckets"), cosine
        )
        kinds = (pa.binary(), pa.binary(), pa.int64())
        return pa.table([pa.array([x[i] for x in out], kinds[i]) for i in range(3)], ["key", "root", "links"])

    linked = stage(placed.groupBy("bucket", "left", "right").applyInArrow(verify, "key binary, root binary, links long"), "links")
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    judged = classes.select("key", F.col("vec_id").alias("class_id"), "copies").join(counts, "key", "left").join(roots, "key", "left")
    judged = stage(judged.withColumn("root", F.coalesce("root", "key")), "judged", narrow=True)
    first = judged.groupBy("root").agg(F.min("class_id").alias("component_id"))
    judged = judged.join(first, "root").select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    keyed = _keys(vectors).join(judged, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return keyed.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _keys(vectors: DataFrame) -> DataFrame:
    """vec_id and the key of its class (null where the vector can't be compared)."""
    own = F.col("embedding").cast("array<double>")
    usable = own.isNotNull() & F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(own, lambda x: x != 0)
    key = F.unhex(F.md5(F.array_join(F.transform(own, lambda x: (x + F.lit(0.0)).cast("string")), ",")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, key).alias("key"))


def op4_vector_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
u AS (SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach(x, y) AS (SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
m AS (SELECT x, min(y) AS least FROM reach GROUP BY x),
e AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(m.least, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(m.least, v.vec_id)) AS kept
FROM v LEFT JOIN e ON e.x = v.vec_id LEFT JOIN m ON m.x = v.vec_id
"""
