import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest

from stratamart.llm import graph, hashing, jaccard_join, substring_dedup

from .conftest import DOCS, doc, phrase


def brute_repeats(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeats(df, **how):
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df, **how).collect()]


@pytest.mark.parametrize("block", [300, 4_000_000])
def test_repeats_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(substring_dedup, "_BLOCK", block)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    expected = [(i, *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows], 35), strict=True)]
    assert sorted(repeats(documents), key=str) == sorted(expected, key=str)


def test_repeats_within_one_text_and_periodic_text(spark):
    part = phrase(8, 35)
    rows = [doc(1, f"{part} gap {part} end"), doc(2, "a b " * 100), doc(3, "a b " * 60), doc(4, part[:-1])]
    df = spark.createDataFrame(rows, DOCS)
    expected = [(r[0], *x) for r, x in zip(rows, brute_repeats([r[1] for r in rows], 35), strict=True)]
    assert sorted(repeats(df)) == sorted(expected)
    assert dict((r[0], r[2]) for r in repeats(df))[1] == 70


def test_repeats_of_nothing_and_extra_columns(spark, no_documents, documents):
    assert repeats(no_documents) == []
    extra = documents.selectExpr("*", "1 AS n_words", "2 AS block", "3 AS part")
    assert sorted(repeats(extra), key=str) == sorted(repeats(documents), key=str)
    kept = substring_dedup.remove_repeats(documents, with_text=True).filter("doc_id = 5").first().kept
    assert kept == "intro here outro"


def test_hashes_do_not_depend_on_neighbours_or_segments(monkeypatch):
    texts = [b"alpha beta", b"", b"  gamma\x0b", b"z" * 5000 + b" beta"]
    whole = hashing.Words(texts)
    monkeypatch.setattr(hashing, "_SEGMENT", 7)
    cut = hashing.Words(texts)
    assert (whole.hash == cut.hash).all() and whole.count.tolist() == [2, 0, 1, 2] == cut.count.tolist()
    assert whole.hash[1] == whole.hash[4] == hashing.Words([b"beta"]).hash[0]


def brute_links(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
            links[i] += 1
            links[j] += 1
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return links, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("size", [3, 400])
def test_join_equals_brute_force(spark, documents, monkeypatch, size):
    monkeypatch.setattr(jaccard_join, "GROUP_TEXTS", size)
    near = [doc(100 + k, " ".join([phrase(9, 100), *(["extra"] * (k % 7)), str(k % 5)])) for k in range(25)]
    df = documents.filter("doc_id IS NOT NULL").unionByName(spark.createDataFrame(near, DOCS))
    rows = sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=lambda r: r[0])
    links, roots = brute_links(rows)
    expected = sorted((r[0], n, rows[k][0]) for r, n, k in zip(rows, links, roots, strict=True))
    got = sorted((r.doc_id, r.n_links, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    assert got == expected


def test_keep_one_of_each_group(spark, documents, no_documents):
    left = jaccard_join.keep_one(documents)
    assert left.columns == documents.columns
    ids = sorted((r.doc_id for r in left.collect()), key=str)
    # 5 is 4 with a frame, 12 came twice as one row; texts without words stay.
    assert ids == sorted([1, 4, 6, 7, 8, 9, 10, 12, None], key=str)
    assert jaccard_join.keep_one(no_documents).count() == 0


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.choose_bands(0.8, 0.995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995 and bands * rows <= 128
    rng = np.random.default_rng(1)
    hit = 0
    for k in range(200):
        words = [f"v{x}" for x in rng.integers(0, 10**9, 300)]
        other = list(words)
        for at in rng.choice(295, 6, replace=False):
            other[at] = "changed"
        _, codes = jaccard_join.band_hashes([" ".join(words).encode(), " ".join(other).encode()], bands, rows)
        hit += (codes[0] == codes[1]).any()
    assert hit >= 198


def test_join_bands_lose_no_pair_at_the_threshold():
    bands, rows = jaccard_join.choose_bands(jaccard_join.THRESHOLD, jaccard_join.RECALL, jaccard_join.MAX_HASHES)
    assert (1 - 0.8**rows) ** bands <= 1e-7
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(2_000):
        # 90 of 100 words in common at one end: 86 n-grams of 106, a similarity of 0.81.
        words = [f"v{x}" for x in rng.integers(0, 10**9, 110)]
        texts += [" ".join(words[:100]).encode(), " ".join(words[:90] + words[100:]).encode()]
    _, codes = jaccard_join.band_hashes(texts, bands, rows)
    assert (codes[::2] == codes[1::2]).any(1).all()


def test_components_of_chains_and_stars(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("900", f"9{k:02}") for k in range(1, 30)] + [("x", "x")]
    found = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a string, b string")).collect())
    assert {found[f"{i:03}"] for i in range(41)} == {"000"} and {found[f"9{k:02}"] for k in range(30)} == {"900"}
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0
