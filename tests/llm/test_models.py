import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import hmm, mixing, vector_lsh

from .conftest import DOCS, doc, phrase


def model_of(classes, states, seed=3):
    rng = np.random.default_rng(seed)
    unit = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Model(unit(rng.random(states), 0), unit(rng.random((states, states)), 1), unit(rng.random((classes, states)), 0))


def test_forward_sums_over_all_paths():
    m, docs = model_of(4, 3), [np.array([0, 3, 1, 1, 2]), np.array([2]), np.array([1, 1, 0])]
    for seq, got in zip(docs, hmm.likelihoods(m, docs), strict=True):
        total = 0
        for path in itertools.product(range(3), repeat=len(seq)):
            p = m.start[path[0]] * m.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= m.move[path[t - 1], path[t]] * m.emit[seq[t], path[t]]
            total += p
        assert got == pytest.approx(math.log(total))
    every = [np.array(s) for s in itertools.product(range(4), repeat=3)]
    assert np.exp(hmm.likelihoods(m, every)).sum() == pytest.approx(1)


def test_order_and_precision_do_not_change_the_likelihood():
    rng = np.random.default_rng(8)
    share = rng.dirichlet(np.ones(40))
    m = hmm.Model.first(share, 4)
    docs = [rng.integers(0, 40, int(n)).astype(np.int32) for n in rng.integers(1, 700, 60)]
    plain = hmm._expectation(m, docs)
    assert plain[3] == pytest.approx(hmm.likelihoods(m, docs).sum(), rel=1e-12)
    for other in (hmm._expectation(m, sorted(docs, key=len)), hmm._expectation(m, docs[::-1])):
        assert all(np.allclose(x, y, rtol=1e-9) for x, y in zip(plain, other, strict=True))
    single = hmm._expectation(m, docs, np.float32)
    assert single[3] == pytest.approx(plain[3], rel=1e-7)
    assert all(np.allclose(x, y, rtol=1e-3, atol=1e-3) for x, y in zip(plain[:3], single[:3], strict=True))


def test_expected_counts_and_rising_likelihood():
    m, rng = model_of(6, 3), np.random.default_rng(0)
    docs = [rng.integers(0, 6, n) for n in (40, 7, 1, 90)]
    start, move, emit = hmm.expected_counts(m, docs)
    assert start.sum() == pytest.approx(4) and move.sum() == pytest.approx(138 - 4) and emit.sum() == pytest.approx(138)
    before = hmm.likelihoods(m, docs).sum()
    for _ in range(5):
        start, move, emit = hmm.expected_counts(m, docs)
        m = hmm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        after = hmm.likelihoods(m, docs).sum()
        assert after >= before - 1e-9
        before = after


@pytest.mark.parametrize("head", [3, 200_000])
def test_base_scores_equal_brute_force(spark, documents, monkeypatch, head):
    monkeypatch.setattr(hmm, "HEAD", head)
    monkeypatch.setattr(hmm, "CLASSES", min(head, 50))
    df = documents.filter("doc_id IS NOT NULL AND doc_id <> 9").unionByName(spark.createDataFrame([doc(k, "The the cat " + phrase(k % 9, 15)) for k in range(200, 260)], DOCS))
    rows = [tuple(r) for r in df.select("doc_id", "text", hmm.held_out(F.col("doc_id"))).collect()]
    counts = Counter(w for _, t, held in rows if not held for w in hmm.tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i, len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for i, t, _ in rows for w in [hmm.tokens_of(t)])
    trained = hmm.train(df)
    got = hmm.scores(df, trained).collect()
    assert trained.total == n and trained.distinct == v
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert all(r.score < 0 for r in got)


def test_language_model_without_training_rows(spark, no_documents):
    assert hmm.scores(no_documents, hmm.train(no_documents)).count() == 0
    held = next(k for k in range(100) if __import__("zlib").crc32(str(k).encode()) % 5 == 1)
    df = spark.createDataFrame([doc(held, "a b"), doc(held, None)], DOCS)
    got = hmm.scores(df, hmm.train(df)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3] and all(r.base_score == 0 and r.n_known == 0 for r in got)


def test_training_ends_when_a_round_gains_little(spark):
    rng = np.random.default_rng(1)
    words = [[f"{a}{k}" for k in range(12)] for a in "xy"]
    rows = [doc(k, " ".join([*rng.choice(words[k % 2], 30), "z" * 300])) for k in range(80)]
    df = spark.createDataFrame(rows, DOCS)
    trained = hmm.train(df, states=2)
    assert len(trained.fits) > 2 and trained.fits[-1] - trained.fits[-2] < hmm.TOLERANCE
    own = [r.text for r in df.filter(~hmm.held_out(F.col("doc_id"))).collect()]
    docs = hmm._class_docs(own, hmm.Numbers(trained.head))
    share = np.append(trained.counts, max(0.5, trained.total - trained.counts.sum())) / max(trained.total, 1)
    more = hmm.Model.of_counts(*hmm.expected_counts(trained.model, docs), share)
    assert hmm.likelihoods(more, docs).sum() - hmm.likelihoods(trained.model, docs).sum() < hmm.TOLERANCE * trained.total
    # The long token is counted, but not collected.
    assert max(map(len, trained.head)) <= hmm.HEAD_BYTES and trained.total == sum(len(hmm.tokens_of(t)) for t in own)
    assert all(r.n_known == r.n_tokens for r in hmm.scores(df, trained).collect())


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, fixed = {}, set()
    while True:
        free = sum(sizes.values()) - sum(3 * sizes[s] for s in fixed)
        share = sum(weight[s] for s in names if s not in fixed)
        target = {s: 3 * sizes[s] if s in fixed else free * weight[s] / share for s in names}
        above = {s for s in names if s not in fixed and target[s] > 3 * sizes[s]}
        if not above:
            return target
        fixed |= above


def test_mixing_meets_its_targets(spark, documents, no_documents):
    rows = [doc(1000 + k, "word " * (k % 40 + 1), ("a", "b", "c", "d", None)[k % 5 if k < 60 else 1]) for k in range(900)]
    df = documents.unionByName(spark.createDataFrame(rows, DOCS))
    mixed = mixing.mix(df.selectExpr("*", "1 AS size", "2 AS target"))
    got = mixed.collect()
    assert len(got) == df.count() and all(r.copies <= 3 for r in got)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        longest[r.source] = max(longest[r.source], r.size)
    targets = brute_targets(sizes)
    for r in got:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in sizes)
    again = sorted((str(r.doc_id), r.copies) for r in mixing.mix(df).collect())
    assert again == sorted((str(r.doc_id), r.copies) for r in got)
    repeated = mixing.mixed_rows(df)
    assert repeated.count() == sum(r.copies for r in got) and repeated.columns == [*df.columns, "repetition"]
    assert mixing.mix(no_documents).count() == 0
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


VECTORS = "vec_id long, embedding array<float>, label int"


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_lsh, "GROUP", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 32))
    x = np.concatenate([centres, centres[:12] + 0.08 * rng.normal(size=(12, 32)), np.repeat(centres[:1], 9, 0), centres[1] + 0.1 * rng.normal(size=(25, 32))]).astype(np.float32)
    rows = [(k, [float(c) for c in v], 0) for k, v in enumerate(x)]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 32, 0), (903, [float("nan")] * 32, 0), (904, [None] + [1.0] * 31, 0), (905, [float("inf")] + [0.0] * 31, 0), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0)]
    got = {r.vec_id: r for r in vector_lsh.near_vectors(spark.createDataFrame(rows + odd, VECTORS).selectExpr("*", "1 AS key", "2 AS bucket")).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    wanted = near.sum(1)
    found = np.array([got[k].n_links for k in range(len(x))])
    assert (found <= wanted).all() and found.sum() >= 0.95 * wanted.sum()
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(900, 906))
    assert got[907].n_links == 1 and got[907].component_id == 906 and not got[907].kept
    assert vector_lsh.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.9 * a + math.sqrt(1 - 0.81) * b
    for n in (10_000, 60_000, 3_000_000):
        tables, hashes = vector_lsh.settings(n, 64)
        x, y = (vector_lsh.codes(v, tables, hashes) for v in (a, b))
        assert ((x == y[:, :, :1]) | (y == x[:, :, :1])).any((1, 2)).mean() >= 0.9
    assert np.allclose(np.linalg.norm(vector_lsh.hadamard(a), axis=1), 1)


@pytest.mark.parametrize(("length", "sizes"), [(64, (1_000, 50_000, 10_000_000)), (128, (1_000, 50_000, 10_000_000)), (384, (1_000, 50_000)), (768, (1_000, 50_000))])
def test_recall_at_the_threshold_in_every_dimension(length, sizes):
    rng, unit = np.random.default_rng(4), lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    a = unit(rng.normal(size=(300, length)))
    b = rng.normal(size=a.shape)
    b = 0.9 * a + math.sqrt(1 - 0.81) * unit(b - (b * a).sum(1)[:, None] * a)
    for n in sizes:
        tables, hashes = vector_lsh.settings(n, length)
        x, y = (vector_lsh.codes(v, tables, hashes) for v in (a, b))
        assert ((x == y[:, :, :1]) | (y == x[:, :, :1])).any((1, 2)).mean() >= 0.95


@pytest.mark.parametrize("length", [64, 128, 384, 768])
@pytest.mark.parametrize("n", [10_000_000, 100_000_000])
def test_tables_make_up_for_the_meeting_rate(length, n):
    tables, hashes = vector_lsh.settings(n, length)
    assert 1 - (1 - vector_lsh.meeting_rate(length, hashes, 0.9)) ** tables >= 0.95
    assert vector_lsh.settings(n, length, cosine=0.95)[0] < tables
