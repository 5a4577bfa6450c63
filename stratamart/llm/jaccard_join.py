"""Near-duplicate join on word n-gram sets: MinHash bands find candidates, full sets decide.

Band and row counts follow from the threshold and the target recall. Equal texts are one
class and are compared once. Band hashes are shuffled without the texts; classes that share
a bucket are linked to the bucket's smallest class, and the components of these links are
the groups within which pairs are verified. Only members of such groups have their n-gram
sets shuffled. A group above ``GROUP_TEXTS`` texts or ``GROUP_GRAMS`` n-grams is cut into
blocks and each pair of blocks is a task of its own, so that one large group is spread out
and every pair is still compared exactly once. A task gives back each text's number of
links and a spanning forest, never the pairs.

Defined cases: null texts and texts without words have no n-grams and link to nothing, not
even to each other; a text of fewer than n words is one n-gram; repeated rows count as
copies; an empty table gives an empty result; other columns are ignored here, and kept by
:func:`keep_one`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage, table, unused
from stratamart.llm.graph import components, local_roots
from stratamart.llm.hashing import Words, mix, shingles

GRAM = 5
THRESHOLD = 0.8
# A pair at the threshold itself is missed once in ten million; closer pairs less often still.
RECALL = 1 - 1e-7
MAX_HASHES = 208
GROUP_TEXTS = 400
GROUP_GRAMS = 200_000
_CHUNK = 2_000_000
_DENSE = 2048


def choose_bands(threshold: float, recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows) with the most rows a band, and so the fewest candidates, that still reach the recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no bands within max_hashes reach the recall")
    return best


def band_hashes(texts: list[bytes], bands: int, rows: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(texts with n-grams, their band hashes)."""
    value, text = shingles(Words(texts), gram)
    have, begin = np.unique(text, return_index=True)
    factor = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros((len(have), bands), np.uint64)
    for b in range(bands if len(have) else 0):
        code = np.full(len(have), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            code = mix(code * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(mix(value * factor[k]) if k == 0 else value * factor[k], begin))
        out[:, b] = code
    return have, out.view(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int = _CHUNK) -> Iterator[tuple[list, list[bytes]]]:
    """Rows (all columns but the last, text) in pieces of about ``limit`` bytes."""
    rows, texts, size = [], [], 0
    for batch in batches:
        for *row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.append(row)
            texts.append(b"" if text is None else text.encode())
            size += len(texts[-1])
            if size >= limit:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _signatures(docs: DataFrame, bands: int, rows: int, gram: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            have, codes = band_hashes(texts, bands, rows, gram)
            keys, lists = [None] * len(texts), [None] * len(texts)
            for i, code in zip(have.tolist(), codes, strict=True):
                keys[i] = hashlib.md5(texts[i]).digest()
                lists[i] = code
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in ids], pa.int64()), pa.array(keys, pa.binary()), pa.array([len(t.split()) for t in texts], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_words", "bands"],
            )

    rows_ = docs.select(F.col("doc_id").cast("long"), "text")
    return stage(rows_.mapInArrow(sign, "doc_id long, key binary, n_words long, bands array<long>"), "signatures")


def _overlaps(grams: list[np.ndarray]) -> np.ndarray:
    """The number of common n-grams of every two texts of a block."""
    n = len(grams)
    owner = np.repeat(np.arange(n), [len(g) for g in grams])
    _, column, df = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    keep = df[column] > 1
    owner, column = owner[keep], column[keep]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, _DENSE):
        a, b = np.searchsorted(column, [low, low + _DENSE])
        dense = np.zeros((n, _DENSE), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        used = np.unique(owner[a:b])
        total[np.ix_(used, used)] += dense[used] @ dense[used].T
    return total


def _verify(left: int, right: int, rows: list[tuple], threshold: float, gram: int) -> list[tuple[bytes, bytes, int]]:
    """Links of one group or pair of blocks: (text, smallest text of its local component, number of linked rows)."""
    rows = sorted({r[0]: r for r in rows}.values())
    value, text = shingles(Words([r[3] for r in rows]), gram)
    grams = [np.unique(x) for x in np.split(value, np.searchsorted(text, np.arange(1, len(rows))))]
    size, copies = np.array([len(g) for g in grams], np.float32), np.array([r[2] for r in rows], np.int64)
    block = np.array([r[1] for r in rows])
    common = _overlaps(grams)
    linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-4
    linked &= (block[:, None] != block[None, :]) | (left == right)
    np.fill_diagonal(linked, False)
    links = linked @ copies
    root = local_roots(len(rows), *np.nonzero(linked))
    return [(rows[i][0], rows[r][0], int(links[i])) for i, r in enumerate(root) if links[i]]


def _candidates(classes: DataFrame) -> DataFrame:
    """(node, root): classes that share buckets, and the candidate group they belong to."""
    buckets = classes.select("key", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("key").alias("hub"), F.max("key").alias("last")).filter("hub <> last")
    edges = buckets.join(hubs, "bucket").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    return stage(components(edges), "groups", narrow=True)


def _links(docs: DataFrame, classes: DataFrame, threshold: float, gram: int) -> DataFrame:
    """(key, root, links) of every block a class was compared in."""
    groups = _candidates(classes)
    members = groups.join(classes.select("key", "class_id", "copies", "n_words"), groups.node == F.col("key")).drop("node")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_TEXTS), F.ceil(F.sum("n_words") / GROUP_GRAMS)).cast("int")
    sizes = members.groupBy("root").agg(blocks.alias("blocks"))
    members = stage(members.join(sizes, "root"), "members", narrow=True).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    # A merge join at every size: the members grow with the corpus and are never broadcast.
    chosen = members.select(F.col("class_id").alias("chosen_id"), "key", "root", "copies", "block", "blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen.hint("merge"), F.col("doc_id").eqNullSafe(F.col("chosen_id")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = texts.select("key", "root", "copies", "block", "text", other.alias("other")).select(
        "root", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "key", "block", "copies", "text"
    )

    def verify(part: tuple, group: pa.Table) -> pa.Table:
        _, left, right = (x.as_py() for x in part)
        columns = [group.column(c).to_pylist() for c in ("key", "block", "copies", "text")]
        rows = [(k, b, c, t.encode()) for k, b, c, t in zip(*columns, strict=True) if t is not None]
        rows = [r for r in rows if hashlib.md5(r[3]).digest() == r[0]]
        out = _verify(left, right, rows, threshold, gram) if rows else []
        kinds = (pa.binary(), pa.binary(), pa.int64())
        return pa.table([pa.array([x[i] for x in out], kinds[i]) for i in range(3)], ["key", "root", "links"])

    return stage(placed.groupBy("root", "left", "right").applyInArrow(verify, "key binary, root binary, links long"), "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, gram: int = GRAM) -> DataFrame:
    """A row per document: doc_id, key of its text, class_id, n_links, component_id, kept, and whether its row repeats."""
    bands, rows = choose_bands(threshold, recall, MAX_HASHES)
    signed = _signatures(docs, bands, rows, gram)
    per_id = signed.filter("key IS NOT NULL").groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands"))
    classes = per_id.groupBy("key").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("o"), "doc_id", "n")).alias("least"),
        F.sum("n").alias("copies"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands"),
    )
    classes = stage(
        classes.select("key", F.col("least.doc_id").alias("class_id"), "copies", (F.col("least.n") > 1).alias("repeated"), "n_words", "bands"), "classes"
    )
    linked = _links(docs, classes, threshold, gram)
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    judged = classes.select("key", "class_id", "copies", "repeated").join(counts, "key", "left").join(roots, "key", "left")
    judged = stage(judged.withColumn("root", F.coalesce("root", "key")), "judged", narrow=True)
    first = judged.groupBy("root").agg(F.min(F.struct(F.col("class_id").isNull(), "class_id", "key")).alias("first"))
    judged = judged.join(first, "root").select(
        "key", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.col("first.class_id").alias("component_id"), (F.col("key") == F.col("first.key")).alias("leads"), "repeated",
    )
    own = signed.select("doc_id", "key").join(judged, "key", "left")
    return own.select(
        "doc_id", "key",
        F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("leads") & F.col("doc_id").eqNullSafe(F.col("component_id")), F.lit(True)).alias("kept"),
        F.coalesce("repeated", F.lit(False)).alias("repeated"),
    )


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest id."""
    verdict = stage(near_duplicates(docs, **how), "verdict")
    key = F.unhex(F.md5("text"))
    v_id, v_key = unused(docs, "v_id", "v_key")

    def among(rows: DataFrame) -> tuple[DataFrame, object]:
        chosen = rows.select(F.col("doc_id").alias(v_id), F.col("key").alias(v_key)).distinct()
        return chosen, F.col("doc_id").eqNullSafe(F.col(v_id)) & (key == F.col(v_key))

    rest = docs.join(*among(verdict.filter("NOT kept")), "left_anti")
    if verdict.filter("kept AND repeated").isEmpty():
        return rest
    twice = among(verdict.filter("kept AND repeated"))
    return rest.join(*twice, "left_anti").unionByName(rest.join(*twice, "left_semi").dropDuplicates(["doc_id", "text"]))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "component_id", "kept")


OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN z p ON p.doc_id = x JOIN z q ON q.doc_id = y WHERE 9 * k >= 4 * (p.n + q.n)),
reach(x, y) AS (SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
m AS (SELECT x, min(y) AS least FROM reach GROUP BY x),
e AS (SELECT x, count(*) AS n FROM l GROUP BY x),
t AS (SELECT doc_id, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY text) ELSE doc_id END AS class_id FROM d)
SELECT t.doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links, least(t.doc_id, coalesce(m.least, t.doc_id)) AS component_id,
       t.doc_id = least(t.doc_id, coalesce(m.least, t.doc_id)) AS kept
FROM t LEFT JOIN e ON e.x = t.doc_id LEFT JOIN m ON m.x = t.doc_id
"""
