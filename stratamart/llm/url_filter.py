"""URL filter with Bloom filter cascades: exact membership of listed keys among all keys of the corpus, without joins.

A rule is a host and the beginning of a path; it fits the host, its subdomains and all paths
that begin so. The keys of a page are all host suffixes times the path beginnings of the
lengths that rules have, so every rule that fits a page is one of its keys.

Level 0 of a cascade encodes the listed keys; level 1 the keys of the corpus that level 0
takes for listed and that are not; level 2 the listed keys that level 1 takes for
those, and so on until nobody is mistaken. The answer for a key of the corpus is then exact. The
corpus is scanned for level 1 only, and only the keys that pass level 0 are compared with
the list. The longest listed key of a page wins; a page without one is allowed.

A cascade is sent to every task: 10 bits a listed key and less for the levels above, checked
against ``max_bytes``. Longer lists are looked up by a join on the key instead.

Defined cases: a null url or one without ``://`` has an empty host and path and fits only
rules with an empty host; of equal rules listed twice with different verdicts, block wins;
without rules all is allowed; repeated rows are judged alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import ascii_lower, stage, table
from stratamart.llm.hashing import mix

# The rules of the query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BITS = 10
PROBES = 7
MAX_BYTES = 256_000_000
_KEYED = "key string, h1 long, h2 long"


def host_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def page_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of a page: every host suffix with every path beginning of one of the lengths."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"))


class Level:
    """A Bloom filter; ``level`` changes the places, so that one level's mistakes are not the next one's."""

    def __init__(self, level: int, words: np.ndarray):
        self.level, self.words = level, words

    @staticmethod
    def size(n: int) -> int:
        """64-bit words for n keys."""
        return max(1, -(-n * BITS // 64))

    @staticmethod
    def places(level: int, size: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        a, b = mix(h1.view(np.uint64) + np.uint64(level)), mix(h2.view(np.uint64)) | np.uint64(1)
        return (a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) % np.uint64(64 * size)

    def __contains__(self, _: object) -> bool:
        raise TypeError("use has()")

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(self.level, len(self.words), h1, h2)
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(1)


def encode(keys: DataFrame, level: int, n: int) -> Level:
    """A filter over ``keys`` (h1, h2): tasks set bits, words are combined in a shuffle, the words reach the driver."""
    size = Level.size(n)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size, np.uint64)
        for batch in batches:
            at = Level.places(level, size, *(batch.column(i).to_numpy() for i in (0, 1))).ravel()
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["word", "bits"])

    found = keys.select("h1", "h2").mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Level(level, words)


class Cascade:
    """Alternating levels; exact for the keys that it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
        for k, level in enumerate(self.levels):
            passed = level.has(h1[open_], h2[open_])
            out[open_[~passed]] = k % 2 == 1
            open_ = open_[passed]
        out[open_] = len(self.levels) % 2 == 1
        return out


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(batch.column(1).to_numpy(), batch.column(2).to_numpy())))

    return keys.mapInArrow(keep, _KEYED)


def build(listed: DataFrame, universe: DataFrame, max_levels: int = 40) -> Cascade:
    """The cascade of ``listed`` keys over ``universe``, which may repeat keys and hold listed ones (both: key)."""
    own = stage(_hashed(listed.distinct()), "listed")
    n = own.count()
    if not n:
        return Cascade([])
    levels = [encode(own, 0, n)]
    mistaken = stage(_passing(_hashed(universe), levels[0]).distinct().join(own.select("key"), "key", "left_anti"), "mistaken")
    sides = [own, mistaken]
    for k in range(1, max_levels):
        # Level k encodes those of one side that pass all below; then the other side is tried against it.
        n = sides[k % 2].count()
        if not n:
            return Cascade(levels)
        levels.append(encode(sides[k % 2], k, n))
        other = (k + 1) % 2
        sides[other] = stage(_passing(sides[other], levels[-1]), "mistaken")
    raise RuntimeError("the cascade did not close")


def judge(pages: DataFrame, rules: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url); ``rules``: host, path, verdict."""
    keyed = rules.select(F.concat("host", "path").alias("key"), "verdict").groupBy("key").agg(F.max("verdict").alias("verdict"))
    keyed = stage(keyed, "rules")
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect()) or [0]
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("keys", page_keys(F.col("host"), F.col("path"), lengths))
    if keyed.count() * BITS // 4 > max_bytes:
        return _judge_by_join(parts, keyed)
    universe = parts.select(F.explode("keys").alias("key"))
    lists = {v: build(keyed.filter(F.col("verdict") == v).select("key"), universe) for v in ("block", "allow")}
    shared = pages.sparkSession.sparkContext.broadcast(lists)
    kind = pages.schema["page_id"].dataType.simpleString()
    names = f"page_id {kind}, host string, path string, rule string, verdict string"

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.array([len(x) for x in batch.column(3)], np.int64)
            flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (4, 5, 6)]
            h1, h2, size = (np.asarray(x, np.int64) for x in flat)
            block, allow = (shared.value[v].listed(h1, h2) for v in ("block", "allow"))
            row = np.repeat(np.arange(n), counts)
            order = np.lexsort((np.where(block | allow, size, -1), row))
            last = np.cumsum(counts) - 1
            best = np.where(counts > 0, order[np.clip(last, 0, None)] if len(order) else 0, -1)
            hit = np.array([b >= 0 and bool(block[b] or allow[b]) for b in best.tolist()], bool)
            keys = batch.column(3).flatten()
            rule = [keys[b].as_py() if ok else None for b, ok in zip(best.tolist(), hit.tolist(), strict=True)]
            verdict = ["block" if ok and block[b] else "allow" for b, ok in zip(best.tolist(), hit.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict)], [x.split()[0] for x in names.split(", ")])

    hashes = [F.transform("keys", lambda k: F.xxhash64(k)).alias("h1"), F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))).alias("h2"), F.transform("keys", lambda k: F.length(k)).alias("size")]
    return parts.select("page_id", "host", "path", "keys", *hashes).mapInArrow(decide, names)


def _judge_by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same verdicts by a join on the key, for lists too long to send."""
    found = parts.select("host", "path", "keys").distinct().select("host", "path", F.explode("keys").alias("key")).join(rules, "key")
    best = found.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict")
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)


OP3_SQL = r"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r),
f AS (SELECT *, host = 'net' OR ends_with(host, '.net') AS net, host = 'example.net' OR ends_with(host, '.example.net') AS enet,
        host = 'example.com' OR ends_with(host, '.example.com') AS ecom, host = 'org' OR ends_with(host, '.org') AS org FROM p),
w AS (SELECT *, CASE WHEN enet AND starts_with(path, '/en/') THEN 'example.net/en/' WHEN net AND starts_with(path, '/') THEN 'net/'
        WHEN ecom AND starts_with(path, '/de/') THEN 'example.com/de/' WHEN org AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule FROM f)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM w
"""
