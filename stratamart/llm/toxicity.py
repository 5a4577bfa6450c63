"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

Voters. From a bounded sample of labelled rows (at most ``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` texts, the smallest md5 of the id; the held-out third is never touched)
whole words and word beginnings are counted by label, and a greedy cover picks those that
explain further toxic texts: copies of one text cannot fill the lexicon. The lexicon is dealt
to ``GROUPS`` lexicon voters by strength and one pattern voter for word beginnings; density, repetition and
absence voters join them.

Label model. The votes of all documents (a bit mask each, so at most 2**voters counts) are
fitted by expectation-maximisation: class share and each voter's rate per class, then the
remaining correlations within the classes, by which the weight of voters that repeat
each other is divided.

Classifier. A logistic regression over the lexicon entries and the text's hit counts is
trained on the posterior labels of the sample, and scores every whole text. It never sees
labels, lang, source or doc_id.

Defined cases: a null or wordless text is scored like a text without hits; conflicting label
rows of one id count as toxic; null labels are no labels; without toxic labels the lexicon is
empty and every score low; repeated rows are scored alike; an empty table gives an
empty result; other columns pass through :func:`reject_toxic` and are ignored elsewhere.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage, table, unused

SAMPLE_TOXIC = 6_000
SAMPLE_CLEAN = 12_000
CANDIDATES = 3_000
LEXICON = 120
GROUPS = 6
REJECT = 0.7
_LETTERS = re.compile(r"[^\W\d_]+")
_STEMS = (3, 4, 5, 6, 7, 8)
_VOTERS = GROUPS + 4


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _entries(word: str) -> list[str]:
    """A whole word (ends with a blank) and its beginnings."""
    return [word + " ", *(word[:k] for k in _STEMS if len(word) > k)]


class Lexicon:
    """Chosen entries, and the hits of a text among them."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.number = {e: i for i, e in enumerate(entries)}
        self.seen: dict[str, tuple[int, ...]] = {}

    def hits(self, text: str | None) -> tuple[list[int], int, int]:
        """(entries that occur, words that hit, all words)"""
        found, hit, words = set(), 0, words_of(text)
        if len(self.seen) > 100_000:
            self.seen.clear()
        for word in words:
            own = self.seen.get(word)
            if own is None:
                own = self.seen[word] = tuple(self.number[e] for e in _entries(word) if e in self.number)
            if own:
                hit += 1
                found.update(own)
        return sorted(found), hit, len(words)

    def votes(self, found: list[int], hit: int, words: int) -> int:
        """A bit for each voter: lexicon groups by strength, word beginnings, several hits, dense hits, no hit."""
        mask = 0
        for i in found:
            mask |= 1 << (GROUPS if not self.entries[i].endswith(" ") else i * GROUPS // len(self.entries))
        mask |= (hit >= 2) << (GROUPS + 1) | (hit > 0 and 200 * hit >= words) << (GROUPS + 2) | (hit == 0) << (GROUPS + 3)
        return int(mask)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded sample; the ids to read reach the tasks as a bounded broadcast."""
    own = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    own = own.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.md5(F.col("label_id").cast("string"))
    ids = own.filter("toxic = 1").orderBy(order).limit(SAMPLE_TOXIC).unionByName(own.filter("toxic = 0").orderBy(order).limit(SAMPLE_CLEAN))
    chosen = docs.select("doc_id", "text").join(F.broadcast(stage(ids, "sample-ids")), F.col("doc_id") == F.col("label_id"))
    return stage(chosen.groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")


def _counts(sample: DataFrame) -> list[str]:
    """The entries that set toxic from clean texts apart best, counted once a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = Counter(), Counter()
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                both[toxic].update({e for w in set(words_of(text)) for e in _entries(w)})
            names = list(both[0].keys() | both[1].keys())
            columns = [names, [both[0][x] for x in names], [both[1][x] for x in names]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["entry", "clean", "toxic"])

    size = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic:
        return []
    rate = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    found = (
        sample.mapInArrow(count, "entry string, clean long, toxic long").groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= 5 * (F.col("clean") + 1))
    )
    return [r.entry for r in found.filter(rate >= 8).orderBy((F.col("toxic") * F.log(rate)).desc(), "entry").limit(CANDIDATES).collect()]


def _cover(candidates: list[str], rows: list[tuple[list[int], int]]) -> list[str]:
    """Greedy cover: the entry that explains most texts yet unexplained, less ten times the clean texts it hits."""
    toxic = [set() for _ in candidates]
    clean = np.zeros(len(candidates), np.int64)
    for t, (found, label) in enumerate(rows):
        for i in found:
            if label:
                toxic[i].add(t)
            else:
                clean[i] += 1
    # Of entries that hit the same texts, the most specific one stands for all.
    best: dict[frozenset, int] = {}
    for i in sorted(range(len(candidates)), key=lambda k: (candidates[k].endswith(" "), len(candidates[k]), candidates[k])):
        best[frozenset(toxic[i])] = i
    keep = sorted(best.values())
    candidates, toxic, clean = [candidates[i] for i in keep], [toxic[i] for i in keep], clean[keep]
    chosen, covered = [], set()
    least = max(3, sum(label for _, label in rows) // 50)
    while len(chosen) < LEXICON:
        gain = [len(x - covered) - 10 * clean[i] for i, x in enumerate(toxic)]
        i = max(range(len(candidates)), key=lambda k: (gain[k], len(toxic[k]), len(candidates[k]), candidates[k]), default=None)
        if i is None or gain[i] < least:
            # What overlaps with texts already explained, but occurs as often and never in a clean one, still votes.
            often = [k for k in range(len(candidates)) if len(toxic[k]) >= max(5, len(covered) // 50) and clean[k] == 0]
            names = chosen + [candidates[k] for k in often]
            return list(dict.fromkeys(names))[:LEXICON]
        chosen.append(candidates[i])
        covered |= toxic[i]
    return chosen


def label_model(masks: np.ndarray, n: np.ndarray, share: float, rounds: int = 50) -> np.ndarray:
    """P(toxic) of every vote mask, by EM over (mask, number of documents) and a correlation discount."""
    votes = ((masks[:, None] >> np.arange(_VOTERS)) & 1).astype(float)
    post = np.where(votes[:, -1] > 0, 0.02, 0.9)
    weight = n / max(1.0, n.sum())
    for _ in range(rounds):
        p1 = np.clip((weight * post).sum(), 1e-4, 0.9)
        p1 = 0.5 * (p1 + share)
        one = ((weight * post) @ votes + 1e-6) / ((weight * post).sum() + 2e-6)
        zero = ((weight * (1 - post)) @ votes + 1e-6) / ((weight * (1 - post)).sum() + 2e-6)
        # Within a class (the likelier one), voters that move together share their evidence.
        off = np.zeros_like(votes)
        for side in (post > 0.5, post <= 0.5):
            off[side] = votes[side] - (weight[side] @ votes[side]) / max(1e-12, weight[side].sum())
        cov = (off * weight[:, None]).T @ off
        sd = np.sqrt(np.diag(cov)) + 1e-9
        shared = 1 / (1 + (np.abs(cov / sd[:, None] / sd[None, :]) - np.eye(_VOTERS)).clip(0).sum(1))
        one, zero = one.clip(1e-5, 1 - 1e-5), zero.clip(1e-5, 1 - 1e-5)
        score = (votes * np.log(one / zero) + (1 - votes) * np.log((1 - one) / (1 - zero))) @ shared
        new = 1 / (1 + np.exp(-np.clip(score + np.log(p1 / (1 - p1)), -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post


def _row(size: int, found: list[int], hit: int, words: int) -> np.ndarray:
    x = np.zeros(size + 4)
    x[found] = 1
    x[size:] = 1, min(hit, 5) / 5, hit > 0, min(1.0, 50 * hit / max(50, words))
    return x


class Model:
    """A lexicon and the classifier's weights."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, text: str | None) -> float:
        return self.of(*self.lexicon.hits(text))

    def of(self, found: list[int], hit: int, words: int) -> float:
        z = _row(len(self.lexicon.entries), found, hit, words) @ self.weights
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _hits(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One pass over the texts: (doc_id, found, hit, words, mask) of every row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [lexicon.hits(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()), pa.array([lexicon.votes(*r) for r in rows], pa.int64()),
                ],
                ["doc_id", "found", "hit", "words", "mask"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, "doc_id long, found array<int>, hit long, words long, mask long")
    return stage(rows, "hits")


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the hits of every document that it was fitted on."""
    sample = _sample(docs, labels)
    candidates = _counts(sample)

    def collected(entries: list[str]) -> list[tuple]:
        lexicon = Lexicon(entries)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [lexicon.hits(t) for t in batch.column(0).to_pylist()]
                columns = [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["found", "hit", "words", "toxic"])

        return [tuple(r) for r in sample.mapInArrow(find, "found array<int>, hit long, words long, toxic int").collect()]

    lexicon = Lexicon(_cover(candidates, [(r[0], r[3]) for r in collected(candidates)]) if candidates else [])
    hits = _hits(docs, lexicon)
    counted = hits.groupBy("mask").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = collected(lexicon.entries)
    own = [lexicon.votes(*r[:3]) for r in rows]
    masks = np.array(sorted({*own, *(r.mask for r in counted)}), np.int64)
    if not len(masks) or not candidates:
        weights = np.zeros(len(lexicon.entries) + 4)
        weights[len(lexicon.entries)] = -6.0
        return Model(lexicon, weights), hits
    n = {r.mask: r.n for r in counted}
    share = labels.filter(~held_out(F.col("doc_id"))).agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.01
    post = dict(zip(masks.tolist(), label_model(masks, np.array([n.get(m, 0) for m in masks.tolist()], float), float(np.clip(share, 1e-3, 0.5))), strict=True))
    weights = _fit(np.array([_row(len(lexicon.entries), *r[:3]) for r in rows]), np.array([post[m] for m in own]))
    return Model(lexicon, weights), hits


def scores(docs: DataFrame, model: Model, out: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``out`` (replaced if there is one)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score).astype("float64")

    return docs.withColumn(out, toxicity("text"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = REJECT) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    model, _ = train(docs, labels)
    score = unused(docs, "score")[0]
    return scores(docs, model, score).filter(F.col(score) < threshold).select(*docs.columns)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, hits = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, hit, words = (batch.column(i).to_pylist() for i in (1, 2, 3))
            p = [model.of(*r) for r in zip(found, hit, words, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array(hit, pa.int64())], ["doc_id", "score", "n_hits"])

    rows = hits.select("doc_id", "found", "hit", "words").mapInArrow(score, "doc_id long, score double, n_hits long")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"), "n_hits")
