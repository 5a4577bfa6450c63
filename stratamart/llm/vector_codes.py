"""Vector code compression: eight one-byte codes a vector, nearest entries found in GNATs over the codebooks.

Components are fixed-point integers, ``floor(4096 x)``, so sums and distances are exact and do not
depend on partitioning. A vector is cut into ``PARTS`` equal parts; the codebook of each part position starts
as that part of the first vectors by id and is moved ``ROUNDS`` times to the floored mean of
the parts assigned to each entry.

Nearest entries come from a GNAT (:class:`Gnat`) for each part position, which every task builds from the few
hundred broadcast integers: split points are chosen far apart, every other entry
belongs to its nearest split point, and for each pair (split point, child) the range of distances from the
point to the child's entries is kept. A query visits split points first; with its best
distance so far, a child whose range cannot hold anything as near is left out with its whole
subtree. Ranges and radii are rounded outwards and left out only where strictly farther, so entries at
equal distance survive; what is compared in the end are integer squared distances, ties to the lower index.

Spark side: vectors are staged once as integers; a round maps them to (part, entry, sums, count), one row
for each entry and task, added up in a shuffle; 8 x 16 entries reach the driver.
Errors are summed by label with partial aggregation, and the sums joined back.

Defined cases: a null vector, or one with null, NaN or infinite components, is dropped, as is an empty
one (it has no parts). Vectors whose length is no multiple of ``PARTS``, or shorter than the longest, count as
filled up with zeros. With fewer than ``ENTRIES`` vectors, codebooks are that small. Among equal vec_ids the
smaller vector comes first, null ids last. Repeated rows are coded alike and count each. A component of
2^14 or more raises, as sums of squares could leave 64 bits. An empty table gives an empty result;
columns besides vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage, table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SPLITS = 4
_LARGEST = 1 << 26
_ROWS = 4_096


class Gnat:
    """A geometric near-neighbour access tree over the integer rows of ``entries``."""

    def __init__(self, entries: np.ndarray, own: np.ndarray | None = None):
        self.entries = entries
        own = np.arange(len(entries)) if own is None else own
        self.splits = self._spread(own)
        rest = np.setdiff1d(own, self.splits)
        squares = _squares(entries[rest][:, None], entries[self.splits][None])
        nearest = squares.argmin(1) if len(rest) else np.zeros(0, np.int64)
        n = len(self.splits)
        # Distances from split point i to the entries of child j; the child's own split point is compared by itself.
        self.low, self.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
        self.children: list[Gnat | None] = []
        for j in range(n):
            members = np.flatnonzero(nearest == j)
            if len(members):
                self.low[:, j], self.high[:, j] = _down(squares[members].min(0)), _up(squares[members].max(0))
            self.children.append(Gnat(entries, rest[members]) if len(members) else None)

    def _spread(self, own: np.ndarray) -> np.ndarray:
        """Split points, each the farthest from those before it."""
        chosen = [own[0]]
        gap = _squares(self.entries[own], self.entries[own[0]])
        while len(chosen) < min(SPLITS, len(own)):
            gap[np.isin(own, chosen)] = -1
            chosen.append(own[gap.argmax()])
            gap = np.minimum(gap, _squares(self.entries[own], self.entries[chosen[-1]]))
        return np.array(chosen)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each query, ties to the lower index."""
        index, best = np.full(len(queries), len(self.entries)), np.full(len(queries), np.iinfo(np.int64).max)
        self._search(queries, np.arange(len(queries)), index, best)
        return index, best

    def _search(self, queries: np.ndarray, alive: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        own = queries[alive]
        squares = np.stack([_squares(own, self.entries[s]) for s in self.splits], 1)
        for i, s in enumerate(self.splits):
            found = squares[:, i]
            better = (found < best[alive]) | ((found == best[alive]) & (s < index[alive]))
            at = alive[better]
            index[at], best[at] = s, found[better]
        near, far = _down(squares), _up(squares)
        for j, child in enumerate(self.children):
            if child is None:
                continue
            radius = _up(best[alive])[:, None]
            # |q e| >= |q p| - |p e| and >= |p e| - |q p|: out only if one of them exceeds the radius for sure.
            beyond = np.nextafter(near - self.high[:, j], -np.inf) > radius
            within = np.nextafter(self.low[:, j] - far, -np.inf) > radius
            left = ~(beyond | within).any(1)
            if left.any():
                child._search(queries, alive[left], index, best)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return (gap * gap).sum(-1)


def _down(squares: np.ndarray) -> np.ndarray:
    """A double not above the root of each integer."""
    return np.maximum(np.nextafter(np.sqrt(np.nextafter(squares.astype(float), 0)), 0), 0)


def _up(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(np.nextafter(squares.astype(float), np.inf)), np.inf)


def kept(vectors: DataFrame, vector: str = "embedding") -> Column:
    """Whether a row's vector can be coded."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite


def _integers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, codes: the components as 64-bit integers), staged, and the filled-up length."""
    rows = vectors.filter(kept(vectors)).select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>").alias("v"))
    top = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if (top[1] or 0) * SCALE >= _LARGEST:
        raise ValueError("a component is too large for exact 64-bit distances")
    length = -(-(top[0] or 0) // PARTS) * PARTS
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(length) - F.size("v")))
    return stage(rows.select("vec_id", "label", F.transform(filled, lambda x: F.floor(x * SCALE)).alias("v")), "integers"), length


def _matrices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            values = part.column(part.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
            yield part, values.reshape(part.num_rows, PARTS, length // PARTS).astype(np.int64)


def _assign(trees: list[Gnat], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = [tree.nearest(np.ascontiguousarray(matrix[:, p])) for p, tree in enumerate(trees)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all vectors."""
    length = books.shape[0] * books.shape[2]
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        trees = [Gnat(b) for b in own]
        sums, counts = np.zeros_like(own), np.zeros(own.shape[:2], np.int64)
        for _, matrix in _matrices(batches, length):
            index, _ = _assign(trees, matrix)
            for p in range(PARTS):
                np.add.at(sums[p], index[:, p], matrix[:, p])
                counts[p] += np.bincount(index[:, p], minlength=own.shape[1])
        part, entry = np.nonzero(counts)
        place = np.tile(np.arange(own.shape[2]), len(part))
        again = lambda x: np.repeat(x, own.shape[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(again(part)), pa.array(again(entry)), pa.array(place), pa.array(sums[part, entry].ravel()), pa.array(again(counts[part, entry]))],
            ["part", "entry", "place", "total", "n"],
        )

    mapped = rows.select("v").mapInArrow(add_up, "part long, entry long, place long, total long, n long")
    found = mapped.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    moved = books.copy()
    at = tuple(found[c].to_numpy() for c in ("part", "entry", "place"))
    moved[at] = found["total"].to_numpy() // found["n"].to_numpy()
    return moved


def codebooks(rows: DataFrame, length: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Final entries by part, entry and place, learnt from all staged rows."""
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), PARTS, length // PARTS).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _moved(rows, np.ascontiguousarray(books))
    return np.ascontiguousarray(books)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every staged row."""
    length = books.shape[0] * books.shape[2]
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in shared.value]
        for batch, matrix in _matrices(batches, length):
            index, squares = _assign(trees, matrix)
            names = [row.tobytes().hex() for row in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(squares.sum(1))], ["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(code, f"vec_id long, label {kind}, code string, error long")


def compress(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Codes and errors (vec_id, label, code, error) of all codable rows of ``vectors``, and the codebooks."""
    rows, length = _integers(vectors)
    if not length:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((PARTS, 0, 0), np.int64)
    books = codebooks(rows, length)
    return stage(encode(rows, books), "codes"), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    by_label = stage(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors", narrow=True)
    by_label = by_label.withColumnRenamed("label", "other")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("other"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    """The rounds written out: each gives the codebooks ``b<k>`` from those before."""
    distance = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - e[i]) * (v[i] - e[i])))"
    nearest = f"SELECT r, p, v, arg_min({{'j': j, 'd': d}}, (d, j)) AS a FROM (SELECT r, q.p, q.v, b.j, ({distance})::BIGINT AS d FROM q JOIN %s b USING (p)) GROUP BY r, p, v"
    steps = []
    for k in range(ROUNDS):
        steps.append(f"""a{k} AS MATERIALIZED ({nearest % f"b{k}"}),
m{k} AS (SELECT p, j, list(c ORDER BY i) AS e FROM (
  SELECT p, a.j AS j, i, ((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS c FROM a{k}, range(1, 1000) AS g(i) WHERE i <= len(v) GROUP BY ALL) GROUP BY p, j),
b{k + 1} AS MATERIALIZED (SELECT p, j, coalesce(m{k}.e, b{k}.e) AS e FROM b{k} LEFT JOIN m{k} USING (p, j))""")
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
  list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (SELECT r, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS v FROM k, range({PARTS}) AS g(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS j, v AS e FROM q WHERE r <= {ENTRIES}),
{", ".join(steps)},
z AS ({nearest % f"b{ROUNDS}"}),
c AS (SELECT r, string_agg(printf('%02x', a.j), '' ORDER BY p) AS code, sum(a.d)::BIGINT AS error FROM z GROUP BY r),
s AS (SELECT sha256(string_agg(x, ',' ORDER BY p, j)) AS h FROM (SELECT p, j, array_to_string(e, ',') AS x FROM b{ROUNDS}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM k JOIN c USING (r), s
"""


OP13_SQL = _sql()
