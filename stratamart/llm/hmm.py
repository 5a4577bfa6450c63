"""Hidden Markov language model: Baum-Welch counts added up over partitions, exact likelihood by scaled forward recursion.

Counts. Tokens of all training texts are counted by task and added up in one shuffle.
Classes. The ``CLASSES`` most frequent training tokens are emission classes of the HMM, all
others share one more class and are told apart by their smoothed unigram share within
it, so the score is the probability of the very token sequence, unseen tokens included.
Training. Class shares shaken by a seeded factor break the symmetry between states; every
round runs forward-backward over all training documents, which are staged once as class
numbers, and the expected counts (states x classes numbers) are added up by a shuffle. Rounds
end when the log-likelihood a token gained less than ``TOLERANCE`` in each of the last ``PATIENCE``
rounds: before states part, the gain can be small for a round or two. A round computes in single
precision and adds up in double; scores are computed in double throughout.
Scoring. Documents of similar length move through the forward recursion in step. Counts of
tokens beyond the ``HEAD`` most frequent ones are looked up by exchange: a block of
documents sends its distinct rare tokens to the partitions that hold their counts and
gets back one number each; the vocabulary is never sent to a task.

Defined cases: a null or empty text is the end token alone; repeated rows are scored alike (and
count twice in training); without training rows N and V are 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import partitions, stage, table

STATES = 8
CLASSES = 8_192
HEAD = 200_000
# Longer tokens are never collected; their counts are looked up like those of rare ones.
HEAD_BYTES = 256
# Natural log a token.
TOLERANCE = 0.005
PATIENCE = 3
_CHUNK = 6_000_000
_GROUP = 512
_CELLS = 4_000_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = b""


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 1


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().translate(_LOWER).split(), END]


class Numbers(dict):
    """Token to number; the last number stands for every other token."""

    def __init__(self, tokens: list[bytes]):
        super().__init__((t, i) for i, t in enumerate(tokens))
        self.other = len(tokens)

    def __missing__(self, token: bytes) -> int:
        return self.other


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows of ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["token", "n"])
            found.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(tokens_of(text))
                if len(found) > 400_000:
                    yield flush()
        yield flush()

    return texts.mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Model:
    """Start, transition and emission probabilities; emission has a row for each class."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, np.ascontiguousarray(emit)

    @classmethod
    def first(cls, share: np.ndarray, states: int) -> Model:
        """Class shares, shaken by a seeded factor for each state; states tend to stay."""
        rng = np.random.default_rng(7)
        emit = (share[:, None] + 1e-9) * rng.gamma(1.0, 1.0, (len(share), states))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        """From expected counts, smoothed towards the class shares (emission) and evenly (start, transitions)."""
        emit = emit + 20.0 * (share[:, None] + 1e-6)
        return cls((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(1, keepdims=True), emit / emit.sum(0))


def _groups(docs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, list[slice]]]:
    """(document numbers, longest first; classes step after step, each step in that order; the rows of each step)."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    while order:
        part = order[: max(1, min(_GROUP, _CELLS // len(docs[order[0]])))]
        order = order[len(part) :]
        own = [docs[i] for i in part]
        lengths = np.array([len(d) for d in own])
        ends = np.cumsum(np.searchsorted(-lengths, -np.arange(lengths[0]), "left"))
        begin = np.append(0, ends[:-1])
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        classes = np.empty(len(step), np.int32)
        classes[begin[step] + np.repeat(np.arange(len(own)), lengths)] = np.concatenate(own)
        yield np.array(part), classes, [slice(a, b) for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]


def likelihoods(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each class sequence, by the scaled forward recursion."""
    out = np.zeros(len(docs))
    for part, classes, steps in _groups(docs):
        total = np.zeros(len(part))
        alpha = np.broadcast_to(model.start, (len(part), len(model.start)))
        for t, rows in enumerate(steps):
            a = rows.stop - rows.start
            alpha = (alpha[:a] @ model.move if t else alpha) * model.emit[classes[rows]]
            scale = alpha.sum(1)
            alpha = alpha / scale[:, None]
            total[:a] += np.log(scale)
        out[part] = total
    return out


def expected_counts(model: Model, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch expectation over ``docs``: counts of starts, transitions and emissions."""
    return _expectation(model, docs)[:3]


def _expectation(model: Model, docs: list[np.ndarray], kind: type = np.float64) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The expected counts, and the natural log probability of ``docs`` under ``model``, computed in ``kind``."""
    s, fit = len(model.start), 0.0
    start, move, emit = np.zeros(s), np.zeros((s, s)), np.zeros_like(model.emit)
    first, ahead, emission = (x.astype(kind) for x in (model.start, model.move, model.emit))
    back, ones = np.ascontiguousarray(ahead.T), np.ones(s, kind)
    for part, classes, steps in _groups(docs):
        seen, alphas, scales = emission[classes], np.empty((len(classes), s), kind), np.empty(len(classes), kind)
        alpha = np.broadcast_to(first, (len(part), s))
        for t, rows in enumerate(steps):
            now, scale = alphas[rows], scales[rows]
            if t:
                np.matmul(alpha[: len(now)], ahead, out=now)
                now *= seen[rows]
            else:
                np.multiply(alpha, seen[rows], out=now)
            np.matmul(now, ones, out=scale)
            now /= scale[:, None]
            alpha = now
        fit += np.log(scales).sum(dtype=float)
        # Backwards only the emissions times beta are kept; all else follows for all steps at once.
        seen /= scales[:, None]
        beta = np.ones((len(part), s), kind)
        for rows in reversed(steps):
            now = seen[rows]
            own = beta[: len(now)]
            now *= own
            np.matmul(now, back, out=own)
        sizes = np.array([rows.stop - rows.start for rows in steps])
        later = seen[len(part) :]
        earlier = np.arange(len(part), len(classes)) - np.repeat(sizes[:-1], sizes[1:])
        move += alphas[earlier].T @ later
        betas = np.ones_like(alphas)
        betas[earlier] = later @ back
        alphas *= betas
        start += alphas[: len(part)].sum(0)
        for k in range(s):
            emit[:, k] += np.bincount(classes, alphas[:, k], len(emit))
    return start, move * model.move, emit, float(fit)


def _class_docs(texts: list[str | None], numbers: Numbers) -> list[np.ndarray]:
    return [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in map(tokens_of, texts)]


def _pieces(column: Iterator[list], size: int = _CHUNK) -> Iterator[list]:
    """Rows (last entry: text) in pieces of about ``size`` characters."""
    rows, total = [], 0
    for part in column:
        for row in part:
            rows.append(row)
            total += len(row[-1] or "")
            if total >= size:
                yield rows
                rows, total = [], 0
    if rows:
        yield rows


def encode(texts: DataFrame, numbers: Numbers) -> DataFrame:
    """(codes) the class numbers of every text, two or four bytes each, staged."""
    shared = texts.sparkSession.sparkContext.broadcast(list(numbers))
    kind = _kind(numbers.other)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Numbers(shared.value)
        for rows in _pieces([(t,) for t in b.column(0).to_pylist()] for b in batches):
            yield pa.RecordBatch.from_arrays([pa.array([d.astype(kind).tobytes() for d in _class_docs([r[0] for r in rows], own)], pa.binary())], ["codes"])

    # Texts of like length share steps, so each partition is written in the order of length.
    return stage(texts.mapInArrow(number, "codes binary").sortWithinPartitions(F.length("codes")), "codes")


def _kind(highest: int) -> str:
    return "<u2" if highest < 1 << 16 else "<i4"


def baum_welch(codes: DataFrame, model: Model, share: np.ndarray) -> tuple[Model, float]:
    """One round over all rows of ``codes``, and their log-likelihood before it; states x classes sums reach the driver."""
    s, shared = len(model.start), codes.sparkSession.sparkContext.broadcast(model)
    kind, height = _kind(len(model.emit) - 1), s + 2 + len(model.emit)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = shared.value, np.zeros((height, s))
        for rows in _pieces(([(c,) for c in b.column(0).to_pylist()] for b in batches), _CHUNK // 3):
            start, move, emit, fit = _expectation(own, [np.frombuffer(r[0], kind).astype(np.int32) for r in rows], np.float32)
            total[:-1] += np.concatenate([move, start[None], emit])
            total[-1, 0] += fit
        row, state = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(state), pa.array(total[row, state])], ["row", "state", "n"])

    sums = codes.mapInArrow(expect, "row long, state long, n double").groupBy("row", "state").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    total = np.zeros((height, s))
    total[sums["row"].to_numpy(), sums["state"].to_numpy()] = sums["n"].to_numpy()
    return Model.of_counts(total[s], total[:s], total[s + 1 : -1], share), float(total[-1, 0])


def fit(codes: DataFrame, model: Model, share: np.ndarray, tokens: int, tolerance: float = TOLERANCE) -> tuple[Model, list[float]]:
    """The model after as many rounds as the tolerance asks for, and the log-likelihood a token before each of them."""
    fits: list[float] = []
    while len(fits) <= PATIENCE or (np.diff(fits[-PATIENCE - 1 :]) >= tolerance).any():
        model, found = baum_welch(codes, model, share)
        fits.append(found / tokens)
    return model, fits


class Trained:
    """The model with the token statistics of its training texts."""

    def __init__(self, model: Model, head: list[bytes], counts: np.ndarray, total: int, distinct: int, table_: DataFrame, fits: list[float]):
        self.model, self.head, self.counts, self.table, self.fits = model, head, counts, table_, fits
        self.total, self.distinct, self.classes = total, distinct, min(CLASSES, len(head))
        own = int(counts[: self.classes].sum())
        self.rest = total - own + 0.5 * (distinct - self.classes + 1)


def train(docs: DataFrame, states: int = STATES, tolerance: float = TOLERANCE) -> Trained:
    """Train on the rows that are not held out."""
    own = docs.select(F.col("doc_id").cast("long"), "text").filter(~held_out(F.col("doc_id")))
    texts = own.select("text")
    counts = stage(count_tokens(texts), "tokens")
    sums = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = sums[0] or 0, sums[1]
    head = counts.filter(F.length("token") <= HEAD_BYTES).orderBy(F.col("n").desc(), "token").limit(HEAD).toArrow()
    names, n = head["token"].to_pylist(), head["n"].to_numpy()
    numbers = Numbers(names[:CLASSES])
    share = np.append(n[:CLASSES], max(0.5, total - n[:CLASSES].sum())).astype(float)
    share /= share.sum()
    model, fits = Model.first(share, states), []
    if total:
        model, fits = fit(encode(texts, numbers), model, share, total, tolerance)
    return Trained(model, names, n, total, distinct, counts, fits)


_BLOCK = "block long, doc_id array<long>, n_tokens array<long>, known array<long>, head_sum array<double>, hmm array<double>, n_rest array<long>, rest_sum array<double>, tail_doc binary, tail_token binary, tail_n binary, order binary, tokens array<binary>"
_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def scores(docs: DataFrame, trained: Trained) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every row."""
    spark = docs.sparkSession
    parts = max(partitions(spark), trained.total // 4_000_000, trained.distinct // 200_000)
    shared = spark.sparkContext.broadcast((trained.model, trained.head, trained.counts, trained.classes))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, head, counts, classes = shared.value
        numbers, logs = Numbers(head), np.append(np.log10(counts + 0.5), 0.0)
        base = TaskContext.get().partitionId() << 32
        rows = ([*zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)] for b in batches)
        for k, piece in enumerate(_pieces(rows)):
            found, stats, tail, tail_doc, tail_token, tail_n = [], [], {}, [], [], []
            for i, (_, text) in enumerate(piece):
                words = tokens_of(text)
                ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                found.append(np.minimum(ids, classes))
                far = np.flatnonzero(ids == len(head))
                rest = ids >= classes
                stats.append((len(ids), len(ids) - len(far), logs[ids].sum(), int(rest.sum()), logs[ids[rest]].sum()))
                for word, n in Counter(words[j] for j in far.tolist()).items():
                    tail_doc.append(i)
                    tail_token.append(tail.setdefault(word, len(tail)))
                    tail_n.append(n)
            hmm = likelihoods(model, found) / np.log(10)
            part = np.fromiter((zlib.crc32(t) % parts for t in tail), np.int64, len(tail))
            order = np.argsort(part, kind="stable")
            names, cuts = list(tail), np.searchsorted(part[order], np.arange(parts + 1))
            sent = [b" ".join(names[j] for j in order[a:b].tolist()) if b > a else None for a, b in zip(cuts, cuts[1:], strict=False)]
            column = lambda x, t: pa.array([x], pa.list_(t))
            raw = lambda x: pa.array([np.asarray(x, np.int32).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([base + k]), column([r[0] for r in piece], pa.int64()), column([s[0] for s in stats], pa.int64()),
                    column([s[1] for s in stats], pa.int64()), column([s[2] for s in stats], pa.float64()), column(hmm.tolist(), pa.float64()),
                    column([s[3] for s in stats], pa.int64()), column([s[4] for s in stats], pa.float64()),
                    raw(tail_doc), raw(tail_token), raw(tail_n), raw(order), column(sent, pa.binary()),
                ],
                [x.split()[0] for x in _BLOCK.split(", ")],
            )

    blocks = stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(block, _BLOCK), "blocks")
    asked = blocks.select("block", F.posexplode("tokens").alias("part", "sent")).filter("sent IS NOT NULL")
    known = trained.table.select(F.pmod(F.crc32("token"), F.lit(parts)).cast("int").alias("part"), "token", "n")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n = dict(zip(right["token"].to_pylist(), right["n"].to_pylist(), strict=True))
        answers = [np.fromiter((n.get(t, 0) for t in sent.split(b" ")), np.int64).tobytes() for sent in left["sent"].to_pylist()]
        return pa.table([left["block"], left["part"], pa.array(answers, pa.binary())], ["block", "part", "counts"])

    answers = asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(look_up, "block long, part int, counts binary")
    unit, rest_unit = np.log10(trained.total + 0.5 * (trained.distinct + 1)), np.log10(trained.rest)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        own = {c: left[c][0].as_py() for c in left.column_names}
        answer = sorted(zip(right["part"].to_pylist(), right["counts"].to_pylist(), strict=True))
        order, n_docs = np.frombuffer(own["order"], np.int32), len(own["doc_id"])
        counts = np.zeros(len(order), np.int64)
        counts[order] = np.frombuffer(b"".join(x for _, x in answer), np.int64)
        doc, token, times = (np.frombuffer(own[c], np.int32) for c in ("tail_doc", "tail_token", "tail_n"))
        c = counts[token]
        tail_sum = np.bincount(doc, times * np.log10(c + 0.5), n_docs)
        n_known = np.array(own["known"]) + np.bincount(doc, times * (c > 0), n_docs).astype(np.int64)
        base = np.array(own["head_sum"]) + tail_sum - np.array(own["n_tokens"]) * unit
        score = np.array(own["hmm"]) + np.array(own["rest_sum"]) + tail_sum - np.array(own["n_rest"]) * rest_unit
        return pa.table([pa.array(own["doc_id"], pa.int64()), pa.array(own["n_tokens"], pa.int64()), pa.array(n_known), pa.array(base), pa.array(score)], [x.split()[0] for x in _SCORED.split(", ")])

    return blocks.drop("tokens").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, _SCORED)


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trained = train(docs)
    return scores(docs, trained).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(trained.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
