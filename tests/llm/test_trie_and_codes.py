"""The prefix trie and the vector codes, against brute force on small inputs."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stratamart.llm import prefix_trie, vector_codes

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    """All nodes by enumerating every prefix of every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in members if len(p) == len(path) + 1 and p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in convs if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rng, n=60, kinds=3):
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, 7))):
            rows.append((c, t, ["user", "assistant"][t % 2], f"té{rng.integers(kinds)}" * (t + 1)))
    return rows


ODD = [
    (1, None, "user", "x"), (1, 1, None, None), (1, 1, None, None), (1, 2, "user", ""), (0, 3, "a", "b"), (0, 1, "c", "d"),
    (None, 1, "user", "lost"), (7, 0, "user", "no base"), (-3, 0, "user", "below"), (-5, 0, "user", "base"), (40, 0, "u", "y" * 200_000), (44, 0, "u", "y" * 200_000),
]


@pytest.mark.parametrize("kinds", [1, 3])
@pytest.mark.parametrize("shard", [4_096, 7])
def test_trie_equals_brute_force(spark, rows, monkeypatch, kinds, shard):
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    found = conversations(np.random.default_rng(kinds), kinds=kinds) + [(c, t, "user", "same") for c in range(100, 140) for t in range(12)]
    trie = prefix_trie.trie(spark.createDataFrame(found, TURNS).repartition(5))
    assert rows(trie) == brute_trie(found)


def test_trie_of_odd_rows(spark, rows):
    docs = spark.createDataFrame([(*r, "extra", 1) for r in ODD], TURNS + ", node string, conv int")
    assert rows(prefix_trie.trie(docs)) == brute_trie(ODD)


def test_long_conversations_are_streamed(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LONG", 10)
    found = [(c, t, "user", f"{t if c < 4 else t * c}") for c in (0, 1, 2, 3, 9) for t in range(40)] + conversations(np.random.default_rng(5), 20)[60:]
    assert rows(prefix_trie.trie(spark.createDataFrame(found, TURNS))) == brute_trie(found)


def test_a_parent_of_many_children_is_joined_by_broadcast(spark, rows):
    found = [(c * 5, t, "user", "hello" if t < 8 else f"{c}") for c in range(300) for t in range(9)]
    trie = prefix_trie.trie(spark.createDataFrame(found, TURNS))
    assert rows(trie) == brute_trie(found)


def test_trie_without_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int"


def brute_codes(vectors):
    """Plain product quantisation with Python integers."""
    good = [(i, [int(np.floor(4096 * float(x))) for x in v], label) for i, v, label in vectors if v and all(x is not None and np.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(good[0][1]) // 8
    cut = [[v[p * width : (p + 1) * width] for p in range(8)] for _, v, _ in good]
    books = [[c[p] for c in cut[:16]] for p in range(8)]
    square = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    nearest = lambda x, book: min((square(x, e), j) for j, e in enumerate(book))
    for _ in range(6):
        for p in range(8):
            own = defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else e for j, e in enumerate(books[p])]
    out, by_label = [], defaultdict(int)
    for (i, _, label), c in zip(good, cut, strict=True):
        found = [nearest(c[p], books[p]) for p in range(8)]
        error = sum(f[0] for f in found)
        by_label[label] += error
        out.append((i, label, "".join(f"{f[1]:02x}" for f in found), error))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return sorted([(i, code, error, by_label[label], hashlib.sha256(flat.encode()).hexdigest()) for i, label, code, error in out], key=repr)


def coded(spark, monkeypatch, vectors, schema=VECTORS):
    monkeypatch.setattr(vector_codes, "table", lambda *_: spark.createDataFrame(vectors, schema).repartition(3))
    return vector_codes.op13_vector_codes(spark, "")


def test_codes_equal_brute_force(spark, rows, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = [(int(i), [float(x) for x in np.float32(rng.normal(size=16))], int(i % 3) if i % 7 else None) for i in rng.permutation(150)]
    assert rows(coded(spark, monkeypatch, vectors)) == brute_codes(vectors)


def test_codes_with_ties_and_repeated_rows(spark, rows, monkeypatch):
    """Small whole numbers: many equal distances and equal entries."""
    rng = np.random.default_rng(2)
    vectors = [(i // 2, [float(x) / 4096 for x in rng.integers(-1, 2, 8)], 1) for i in range(80)] + [(3, [0.0] * 8, 1)] * 5
    assert rows(coded(spark, monkeypatch, vectors)) == brute_codes(vectors)


def test_odd_vectors(spark, rows, monkeypatch):
    good = [(i, [i / 7] * 8, None) for i in range(5)] + [(None, [-0.1] * 8, 4)]
    bad = [(10, None, 1), (11, [None] + [0.1] * 7, 1), (12, [float("nan")] * 8, 1), (13, [float("inf")] * 8, 1), (14, [], 1)]
    extra = [(*r, "x", 0) for r in good + bad]
    assert rows(coded(spark, monkeypatch, extra, VECTORS + ", code string, v int")) == brute_codes(good)
    assert coded(spark, monkeypatch, bad).count() == 0
    assert coded(spark, monkeypatch, []).count() == 0
    # Filled up with zeros to the longest length, a multiple of the parts.
    assert {r["code"] for r in coded(spark, monkeypatch, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5, 0.0], 1)]).collect()} == {"00" * 8}
    with pytest.raises(ValueError, match="too large"):
        coded(spark, monkeypatch, [(1, [1e5] * 8, 1)])


def test_gnat_prunes_and_stays_exact():
    rng = np.random.default_rng(3)
    entries = (rng.normal(size=(200, 4)) * 40 + rng.integers(0, 6, (200, 1)) * 4_000).astype(np.int64)
    entries[50:60] = entries[40:50]
    queries = np.concatenate([entries, entries + rng.integers(-30, 30, entries.shape), rng.integers(0, 24_000, (300, 4))])
    tree, visits = vector_codes.Gnat(entries), []
    search = vector_codes.Gnat._search

    def counted(self, queries, alive, index, best):
        visits.append(len(alive) * len(self.splits))
        search(self, queries, alive, index, best)

    vector_codes.Gnat._search = counted
    try:
        index, best = tree.nearest(queries)
    finally:
        vector_codes.Gnat._search = search
    squares = ((queries[:, None] - entries[None]) ** 2).sum(2)
    assert (index == squares.argmin(1)).all() and (best == squares.min(1)).all()
    assert sum(visits) < squares.size / 3
