"""The run-length index and the matches it finds, against brute force."""

import hashlib

import numpy as np
import pytest

from stratamart.llm import run_index
from tests.llm.conftest import DOCS, doc, phrase


def brute(rows):
    """Remove what 50-byte strings of smaller documents cover."""
    top = 1 << 63
    texts = [(top if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    first: dict[bytes, int] = {}
    for i, t in texts:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(first.get(t[k : k + 50], top), i)
    out = []
    for row, (i, t) in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((row[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def varied(seed=0, n=60):
    """Copies, near copies, repeats within a text, periodic texts, two-byte letters, boundaries of exactly 49 to 51 bytes."""
    rng = np.random.default_rng(seed)
    base = [phrase(k, 40) for k in range(6)]
    rows = []
    for i in range(n):
        text = base[rng.integers(6)]
        at = int(rng.integers(len(text)))
        kind = i % 8
        rows.append(doc(i, [
            text, text[:at] + "é" + text[at:], text[at:] + text[:at], text[:at], "ab" * int(rng.integers(40, 200)),
            f"{i:>20}" + base[0][10 : 10 + 48 + i % 4] + f"{i * 7:>30}", text + text, " " * int(rng.integers(45, 120)),
        ][kind]))
    return rows


ODD = [
    doc(1, None), doc(2, ""), doc(3, phrase(1, 30)), doc(3, phrase(1, 30)), doc(None, phrase(1, 30)), doc(None, phrase(2, 30)), doc(None, phrase(2, 30)),
    doc(-4, "x" + phrase(2, 30)), doc(9, phrase(3, 4_000), "big"), doc(8, phrase(3, 4_000)[500:9_000]), doc(10, "z" * 49), doc(11, "z" * 49), doc(12, "z" * 50), doc(13, "z" * 50),
]


@pytest.mark.parametrize(("heavy", "symbols"), [(10_000, 1_000_000), (3, 1_000_000), (10_000, 500)])
def test_matches_equal_brute_force(spark, rows, monkeypatch, heavy, symbols):
    monkeypatch.setattr(run_index, "HEAVY", heavy)
    monkeypatch.setattr(run_index, "INDEX_SYMBOLS", symbols)
    found = varied()
    assert rows(run_index.remove_matches(spark.createDataFrame(found, DOCS).repartition(7))) == brute(found)


def test_matches_of_odd_rows(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "b") for r in ODD], DOCS + ", part int, block string")
    assert rows(run_index.remove_matches(docs)) == brute(ODD)
    kept = run_index.remove_matches(docs, with_text=True).filter("doc_id = 12").first()
    assert bytes(kept["kept"]) == b"z" * 50
    assert run_index.remove_matches(docs.limit(0)).count() == 0


def test_segments_of_a_block_do_not_matter(spark, rows, monkeypatch):
    monkeypatch.setattr(run_index, "_SEGMENT", 333)
    found = varied(3, 30)
    assert rows(run_index.remove_matches(spark.createDataFrame(found, DOCS).coalesce(1))) == brute(found)


def test_the_result_comes_from_the_index(spark, monkeypatch):
    """Texts that share a passage but are not equal are told apart by the streamed index only."""
    found = [doc(1, phrase(1, 40)), doc(2, "other " + phrase(1, 40) + " end")]
    docs = spark.createDataFrame(found, DOCS)
    assert run_index.remove_matches(docs).filter("doc_id = 2").first()["n_removed"] > 200
    monkeypatch.setattr(run_index, "shard_masks", lambda texts, keys, docs: np.zeros(len(texts), np.uint32))
    # Pieces that are equal as a whole are indexed once; what the blocks send is all that is left without it.
    assert run_index.remove_matches(docs.repartition(2)).agg({"n_removed": "sum"}).first()[0] == 0


def test_backward_steps_equal_counting():
    """Ranges of the run-length transform, for every piece of up to 50 symbols, equal the occurrences in the texts."""
    rng = np.random.default_rng(4)
    texts = list({bytes(rng.integers(97, 99, int(n)).astype(np.uint8)) for n in rng.integers(50, 77, 12)})
    index = run_index.RunIndex(texts, np.arange(len(texts)))
    for text in texts[:4]:
        low, high = np.array([0]), np.array([index.n])
        for k in range(1, 51):
            symbol = np.array([text[-k] + 1])
            low, high = index.extend(symbol, low, high)
            piece = text[len(text) - k :]
            assert high[0] - low[0] == sum(t[i : i + k] == piece for t in texts for i in range(len(t) - k + 1))


def test_copies_add_few_runs():
    base = phrase(9, 12).encode()[:70]
    one, many = (run_index.RunIndex([base] * n, np.arange(n)) for n in (1, 60))
    assert many.n == 60 * one.n and len(many.run_key) < 2 * one.n


def test_masks_name_earlier_documents_only():
    texts = [b"p" * 10 + phrase(1, 9).encode()[:60], phrase(1, 9).encode()[:60]]
    assert run_index.shard_masks(texts, np.zeros(2, np.uint64), np.array([5, 5])).tolist() == [0, 0]
    assert run_index.shard_masks(texts, np.zeros(2, np.uint64), np.array([4, 5])).tolist() == [0, (1 << 11) - 1]
    assert run_index.shard_masks(texts, np.zeros(2, np.uint64), np.array([6, 5])).tolist() == [((1 << 11) - 1) << 10, 0]
    assert run_index.shard_masks([], np.zeros(0, np.uint64), np.zeros(0, np.int64)).tolist() == []
