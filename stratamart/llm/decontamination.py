"""Benchmark decontamination with a distributed positional inverted index.

The index is sharded by document: a task packs a few MB of documents into one shard
and stores the shard's terms and, for each, its sorted positions in the shard's word
stream. It holds every term of the corpus and belongs to no benchmark: build it once
with :func:`index` and ask it about any number of them.

The items are cut into slices of at most ``slice_words`` words; an item longer than
that is cut where no window is lost. For each slice a first step adds up the
frequencies of its terms over all shards, and a second one walks its windows from
their rarest term: the rarest term's positions, shifted by its place in the window,
are intersected with the shifted positions of the next rarest until nothing or the
exact occurrences remain. Only the slice is sent to every task, so a benchmark of any
size is looked up whole, at one pass over the index a slice. Runs of hit words and
items are united a document over the slices.

Defined cases: null and wordless texts have no words, no hits and are clean; an item of
fewer than ``width`` words is one window, one without words has none; equal items all
count; equal rows give equal results, one each; an empty table gives an empty result;
other columns of ``documents`` are ignored here and kept by :func:`decontaminate`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import shared_folder, stage, table, unused

WIDTH = 13
SLICE_WORDS = 500_000
SLICE_BYTES = 32_000_000  # of the benchmark, fetched by the driver at a time
SHARD_BYTES = 2_000_000
HIT_SHARE = 20  # contaminated: at least one hit word in 20

# Letters and digits in lower case, bytes of non-ASCII characters; all else is a gap.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_END = b"\xff"  # ends a document in a shard; no UTF-8 text has this byte

_SHARD = "shard string, doc_ids array<long>, text_keys array<long>, lengths array<int>, terms binary, counts binary, postings binary"
_HIT = "shard string, doc int, spans array<struct<first:long,past:long>>, items array<string>"
_MATCH = "shard string, doc int, doc_id long, item_id string, first long, last long"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_FOLD).split()


class Terms(dict):
    """Word to term number, in the order of first appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Queries:
    """The windows of some items: term numbers, items, and the order in which to intersect."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int = WIDTH):
        terms = Terms()
        windows: dict[tuple[int, ...], set[str]] = {}
        for item_id, words in items:
            ids = [terms[w] for w in words]
            for start in range(max(1, len(ids) - width + 1) if ids else 0):
                windows.setdefault(tuple(ids[start : start + width]), set()).add(item_id)
        self.terms = dict(terms)
        self.items = [sorted(x) for x in windows.values()]
        self.lengths = np.array([len(x) for x in windows], np.int64)
        self.windows = np.full((len(windows), width), -1, np.int32)
        for row, ids in enumerate(windows):
            self.windows[row, : len(ids)] = ids
        self.order = np.zeros_like(self.windows)

    def rank(self, frequency: np.ndarray) -> None:
        """Order each window's places from its rarest term; places past a short window come last."""
        weight = np.where(self.windows >= 0, frequency[self.windows], np.iinfo(np.int64).max)
        self.order = np.argsort(weight, axis=1, kind="stable").astype(np.int32)


def query_slices(benchmark: DataFrame, width: int = WIDTH, slice_words: int = SLICE_WORDS) -> Iterator[Queries]:
    """All windows of all items, at most ``slice_words`` words (but a whole window) at a time."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    longest = max(slice_words, width)
    held, n = [], 0
    for item_id, text in named.repartition(1 + size // SLICE_BYTES).toLocalIterator():
        words = words_of(text)
        for start in range(0, max(1, len(words) - width + 1) if words else 0, longest - width + 1):
            piece = words[start : start + longest]
            if held and n + len(piece) > slice_words:
                yield Queries(held, width)
                held, n = [], 0
            held.append((item_id, piece))
            n += len(piece)
    if held:
        yield Queries(held, width)


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    ids, keys, texts, size = [], [], [], 0

    def packed() -> pa.RecordBatch:
        stream = (b" " + _END + b" ").join([*texts, b""]).translate(_FOLD).split()
        terms = Terms({_END: 0})
        found = np.fromiter(map(terms.__getitem__, stream), np.int32, len(stream))
        counts = np.bincount(found, minlength=len(terms)).astype(np.int32)
        at = np.argsort(found, kind="stable").astype(np.int32)
        ends, at = at[: counts[0]], at[counts[0] :]
        lengths = (np.diff(ends, prepend=-1) - 1).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(pa.int64())), pa.array([keys], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())), pa.array([b" ".join(list(terms)[1:])], pa.binary()),
                pa.array([counts[1:].tobytes()], pa.binary()), pa.array([np.diff(at, prepend=0).astype(np.int32).tobytes()], pa.binary()),
            ],
            ["shard", "doc_ids", "text_keys", "lengths", "terms", "counts", "postings"],
        )

    for batch in batches:
        for doc_id, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            ids.append(doc_id)
            keys.append(key)
            texts.append(b"" if text is None else text.encode())
            size += len(texts[-1])
            if size >= shard_bytes:
                yield packed()
                ids, keys, texts, size = [], [], [], 0
    if ids:
        yield packed()


def index(docs: DataFrame, shard_bytes: int | None = None) -> DataFrame:
    """The stored index over ``docs`` (doc_id, text): one row per shard of documents."""
    shard_bytes = shard_bytes or SHARD_BYTES

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shards(batches, shard_bytes)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text"))
    return stage(rows.mapInArrow(build, _SHARD), "postings")


def _asked(terms: bytes, counts: bytes, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """A query's number of each term of a shard, -1 where it has none, and how often the shard has it."""
    words = terms.split(b" ") if terms else []
    return np.fromiter((known.get(w, -1) for w in words), np.int64, len(words)), np.frombuffer(counts, np.int32).astype(np.int64)


def frequencies(shards: DataFrame, known: dict[bytes, int]) -> np.ndarray:
    """How often each query term occurs in the whole corpus; one row per term reaches the driver."""
    shared = shards.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1), strict=True):
                number, n = _asked(terms.as_py(), counts.as_py(), shared.value)
                total[number[number >= 0]] += n[number >= 0]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])

    rows = shards.select("terms", "counts").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    shared.destroy()
    total = np.zeros(max(1, len(known)), np.int64)
    for row in rows:
        total[row.term] = row.n
    return total


class Shard:
    """A shard as one query slice sees it: the postings of its terms in the order of their numbers."""

    def __init__(self, row: dict, queries: Queries):
        number, n = _asked(row["terms"], row["counts"], queries.terms)
        at = np.cumsum(np.frombuffer(row["postings"], np.int32), dtype=np.int64)
        mine = np.flatnonzero(number >= 0)
        mine = mine[np.argsort(number[mine])]
        self.used, self.counts = number[mine], n[mine]
        begin = np.cumsum(n) - n
        places = np.arange(self.counts.sum()) + np.repeat(begin[mine] - (np.cumsum(self.counts) - self.counts), self.counts)
        self.at = at[places]
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.begins = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.size = int((self.lengths + 1).sum())

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, place, "right") - 1


def occurrences(queries: Queries, used: np.ndarray, counts: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, start in the shard's stream) of every exact occurrence."""
    first = np.zeros(len(queries.terms) + 1, np.int64)
    first[used + 1] = counts
    first = np.cumsum(first)  # first[t]: where the postings of term t begin
    # Direct address table of the postings: a shifted list is intersected by looking its places up here.
    term_at = np.full(size + queries.windows.shape[1], -1, np.int32)
    term_at[at] = np.repeat(used, counts)
    rows = np.arange(len(queries.windows))
    rarest = queries.windows[rows, queries.order[:, 0]]
    n = first[rarest + 1] - first[rarest]
    window = np.repeat(rows, n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[rarest], n)
    start = at[place] - queries.order[window, 0]
    ok = start >= 0
    window, start = window[ok], start[ok]
    for k in range(1, queries.windows.shape[1]):
        place = queries.order[window, k]
        term = queries.windows[window, place]
        ok = (term < 0) | (term_at[start + place] == term)
        window, start = window[ok], start[ok]
    return window, start


def _hits(row: dict, queries: Queries) -> list[tuple]:
    """Of each hit document of a shard: maximal runs of hit words and the items met."""
    shard = Shard(row, queries)
    window, start = occurrences(queries, shard.used, shard.counts, shard.at, shard.size)
    cover = np.zeros(shard.size + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + queries.lengths[window], -1)
    edges = np.diff((np.cumsum(cover) > 0).astype(np.int8), prepend=0)
    first, past = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    found: dict[int, tuple[list, set]] = {}
    for d, f, p in zip(shard.doc(first).tolist(), first.tolist(), past.tolist(), strict=True):
        found.setdefault(d, ([], set()))[0].append({"first": f, "past": p})
    for d, w in set(zip(shard.doc(start).tolist(), window.tolist(), strict=True)):
        found[d][1].update(queries.items[w])
    return [(row["shard"], d, spans, sorted(items)) for d, (spans, items) in found.items()]


def _matches(row: dict, queries: Queries, slop: int) -> list[tuple]:
    """Of each document of a shard: items with the first and last word of a match."""
    shard = Shard(row, queries)
    window, start = occurrences(queries, shard.used, shard.counts, shard.at, shard.size)
    found = {(int(s), int(s + queries.lengths[w] - 1), int(w)) for w, s in zip(window, start, strict=True)}
    if slop:
        lists = np.split(shard.at, np.cumsum(shard.counts)[:-1])
        found |= _near(queries, dict(zip(shard.used.tolist(), lists, strict=True)), shard.begins + shard.lengths, slop)
    rows = []
    for s, e, w in sorted(found):
        d = int(shard.doc(np.array(s)))
        rows += [(row["shard"], d, row["doc_ids"][d], item, s - int(shard.begins[d]), e - int(shard.begins[d])) for item in queries.items[w]]
    return rows


def _ask(shards: DataFrame, benchmark: DataFrame, width: int, slice_words: int, answer: Callable[[dict, Queries], list[tuple]], schema: str) -> DataFrame:
    """The rows ``answer`` gives for each shard and slice; every slice is written before the next one is sent."""
    spark = shards.sparkSession
    path = f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], schema)
    empty.write.parquet(path)
    names = empty.columns

    def asked(shared):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            types = [_ARROW[name] for name in names]
            for batch in batches:
                for i in range(batch.num_rows):
                    rows = answer({name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}, shared.value)
                    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

        return find

    for queries in query_slices(benchmark, width, slice_words):
        queries.rank(frequencies(shards, queries.terms))
        shared = spark.sparkContext.broadcast(queries)
        shards.mapInArrow(asked(shared), schema).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(empty.schema).parquet(path)


_ARROW = {
    "shard": pa.string(), "doc": pa.int32(), "doc_id": pa.int64(), "item_id": pa.string(), "first": pa.int64(), "last": pa.int64(),
    "spans": pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())])), "items": pa.list_(pa.string()),
}


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, slice_words: int = SLICE_WORDS) -> DataFrame:
    """A row per document: doc_id, text_key (xxhash64 of the text), words, hit words, items and the verdict."""
    return judge(index(docs), benchmark, width, slice_words)


def judge(shards: DataFrame, benchmark: DataFrame, width: int = WIDTH, slice_words: int = SLICE_WORDS) -> DataFrame:
    """As :func:`contamination`, over a stored index."""
    hits = _ask(shards, benchmark, width, slice_words, _hits, _HIT)
    united = hits.groupBy("shard", "doc").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    # Runs in the order of their first words: a word counts where it lies behind all runs so far.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("past")),
        lambda seen, run: F.struct(
            (seen["n"] + F.greatest(run["past"] - F.greatest(run["first"], seen["past"]), F.lit(0))).alias("n"),
            F.greatest(run["past"], seen["past"]).alias("past"),
        ),
        lambda seen: seen["n"],
    )
    united = united.select("shard", "doc", covered.alias("hit"), F.size("items").cast("long").alias("met"), F.sha2(F.array_join("items", ","), 256).alias("digest"))
    rows = shards.select("shard", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "lengths")).alias("doc", "row"))
    n_words, n_hit = F.col("row.lengths").cast("long"), F.coalesce("hit", F.lit(0)).cast("long")
    return rows.join(united, ["shard", "doc"], "left").select(
        F.col("row.doc_ids").alias("doc_id"), F.col("row.text_keys").alias("text_key"), n_words.alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce("met", F.lit(0)).cast("long").alias("n_items"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (HIT_SHARE * n_hit >= n_words)).alias("contaminated"),
    )


def matches(docs: DataFrame, benchmark: DataFrame, slop: int = 0, width: int = WIDTH, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Where windows occur: doc_id, item_id, first and last word. With ``slop``, also in order with so many words between."""
    found = _ask(index(docs), benchmark, width, slice_words, lambda row, queries: _matches(row, queries, slop), _MATCH)
    return found.distinct().drop("shard", "doc")


def _near(queries: Queries, postings: dict[int, np.ndarray], ends: np.ndarray, slop: int) -> set[tuple[int, int, int]]:
    """In-order matches: from each place of the first term, the next place of each following one."""
    found = set()
    for w, length in enumerate(queries.lengths):
        lists = [postings.get(t) for t in queries.windows[w, :length].tolist()]
        if any(x is None for x in lists):
            continue
        start = last = lists[0]
        for at in lists[1:]:
            k = np.searchsorted(at, last, "right")
            start, last, k = start[k < len(at)], last[k < len(at)], k[k < len(at)]
            last = at[k]
        ok = (last - start < length + slop) & (np.searchsorted(ends, start) == np.searchsorted(ends, last))
        found |= {(int(s), int(e), w) for s, e in zip(start[ok], last[ok], strict=True)}
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; the verdict is joined by id and text."""
    bad_id, bad_key = unused(docs, "bad_id", "bad_key")
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.xxhash64("text") == F.col(bad_key))
    return docs.join(bad, same, "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
q AS (SELECT DISTINCT item, least(len(w), 13) AS n, md5(array_to_string(w[i:i + 12], ' ')) AS h
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT r, i, n, md5(array_to_string(w[i:i + n - 1], ' ')) AS h
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
o AS (SELECT r, i, s.n, item FROM s JOIN q ON s.n = q.n AND s.h = q.h),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN t ON d.r = t.r
"""
