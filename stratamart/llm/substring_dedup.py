"""Substring dedup: passages that recur are confirmed by content, compiled to automata, and located in every text.

A window is ``width`` consecutive words. Texts are packed into blocks of a few MB.

1. Anchors. In every window the k-gram with the smallest hash is its anchor, so equal
   windows have equal anchors wherever they stand. Each block sends its distinct anchor
   hashes, cut by hash range, to the partitions of the ranges; back comes one bit per anchor:
   does it occur in more than one place?
2. Windows. Of the windows whose anchor recurs, a block sends 96-bit hashes the same way,
   and gets back one bit each.
3. Passages. The recurring windows of a block are tiled into phrases of ``width`` words,
   compiled into the block's Aho-Corasick automaton (one shard each), and every text of the block is
   streamed through it. All words under a match are removed.

Hashes are dealt by range, so no passage, however common, meets in one task: a block sends
each hash once. The text itself is written once and shuffled twice (packed); nothing is
collected.

Defined cases: a null text has no words; a text shorter than ``width`` keeps all of them; equal
rows are other places for each other, so both lose what they share; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import partitions, stage, table
from stratamart.llm.hashing import Words, runs

WIDTH = 35
GRAM = 8
_BLOCK = 4_000_000
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_SENT = "part int, block long, n int, hashes binary, extra binary, many binary"
_ANSWER = "block long, part int, n int, recurs binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over each ``width`` consecutive entries."""
    done = 1
    out = x
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[:-rest], out[rest:]) if rest else out


class Block:
    """The words of a block's texts, its valid windows and their anchors."""

    def __init__(self, texts: list[bytes], width: int, gram: int):
        self.words = w = Words(texts)
        self.width, n = width, len(w.hash)
        if n < width:
            self.valid, self.anchor = np.zeros(0, bool), np.zeros(0, np.uint64)
            self.grams = self.chosen = self.anchor
            return
        grams = runs(w.hash, gram)
        grams[w.text[: len(grams)] != w.text[gram - 1 :]] = _NONE
        span = width - gram + 1
        self.valid = w.text[: n - width + 1] == w.text[width - 1 :]
        self.anchor = np.where(self.valid, _sliding(grams, span, np.minimum), _NONE)
        # A k-gram is a chosen one if some valid window around it has it as its smallest.
        low = np.where(self.valid, self.anchor, np.uint64(0))
        around = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)]), span, np.maximum)
        self.chosen = grams[(around == grams) & (grams != _NONE)]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct anchors, no extra bits, occur more than once here)"""
        value, n = np.unique(self.chosen, return_counts=True)
        return value, np.zeros(0, np.uint32), n > 1

    def windows(self, recurring: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct windows with a recurring anchor, their extra bits, occur more than once here; starts, sorted by window)"""
        start = np.flatnonzero(self.valid & np.isin(self.anchor, recurring))
        hashes = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(start):
            hashes = runs(self.words.hash, self.width)[start], runs(self.words.hash, self.width, 0x9FB21C651E98DF25)[start]
        extra = (hashes[1] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((extra, hashes[0]))
        value, extra, self.start = hashes[0][order], extra[order], start[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (extra[1:] != extra[:-1])
        self.group = np.cumsum(new) - 1
        many = np.bincount(self.group, minlength=int(new.sum())) > 1 if len(value) else np.zeros(0, bool)
        return value[new], extra[new], many, self.start


def _cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash range begins in sorted hashes."""
    bounds = [((1 << 64) * p) // parts for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(bounds, np.uint64)), [len(hashes)]])


def _sent(block: int, hashes: np.ndarray, extra: np.ndarray, many: np.ndarray, parts: int) -> pa.RecordBatch:
    cuts, has_extra = _cuts(hashes, parts), len(extra) > 0
    own = [p for p in range(parts) if cuts[p + 1] > cuts[p]]
    cut = lambda x, p: x[cuts[p] : cuts[p + 1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(own, pa.int32()), pa.array([block] * len(own), pa.int64()), pa.array([int(cuts[p + 1] - cuts[p]) for p in own], pa.int32()),
            pa.array([cut(hashes, p).tobytes() for p in own], pa.binary()), pa.array([cut(extra, p).tobytes() if has_extra else b"" for p in own], pa.binary()),
            pa.array([np.packbits(cut(many, p)).tobytes() for p in own], pa.binary()),
        ],
        [x.split()[0] for x in _SENT.split(", ")],
    )


def _recurring(sent: DataFrame) -> DataFrame:
    """For each part: which of the hashes that a block sent occur in another block, or several times in it."""

    def compare(group: pa.Table) -> pa.Table:
        order = np.argsort(group["block"].to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        n = group["n"].to_numpy()
        value = np.frombuffer(b"".join(group["hashes"].to_pylist()), np.uint64)
        extra = np.frombuffer(b"".join(group["extra"].to_pylist()), np.uint32)
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=int(k)) for m, k in zip(group["many"].to_pylist(), n, strict=True)]).astype(bool)
        rank = np.lexsort((extra, value)) if len(extra) else np.argsort(value, kind="stable")
        value, extra = value[rank], extra[rank] if len(extra) else extra
        same = value[1:] == value[:-1]
        if len(extra):
            same &= extra[1:] == extra[:-1]
        recurs = np.zeros(len(value), bool)
        recurs[rank] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        recurs |= many
        ends = np.cumsum(n)
        bits = [np.packbits(recurs[e - k : e]).tobytes() for e, k in zip(ends, n, strict=True)]
        return pa.table([group["block"], group["part"], group["n"], pa.array(bits, pa.binary())], ["block", "part", "n", "recurs"])

    return sent.groupBy("part").applyInArrow(compare, _ANSWER)


def _bits(rows: list[tuple[int, int, bytes]]) -> np.ndarray:
    """The answers of all parts, in the order of the hashes sent."""
    parts = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n) for _, n, bits in sorted(rows)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _opened(left: pa.Table) -> tuple[list[int | None], list[bytes]]:
    ids, lengths = left["doc_ids"][0].as_py(), left["lengths"][0].as_py()
    raw = zstandard.ZstdDecompressor().decompress(left["texts"][0].as_py(), max_output_size=max(1, sum(lengths)))
    at = np.cumsum([0, *lengths]).tolist()
    return ids, [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def _pack(docs: DataFrame) -> DataFrame:
    names = "block long, doc_ids array<long>, lengths array<int>, texts binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, ids, texts, size = TaskContext.get().partitionId() << 32, 0, [], [], 0

        def packed() -> pa.RecordBatch:
            raw = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([base + number]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int32())), pa.array([raw], pa.binary())],
                [x.split()[0] for x in names.split(", ")],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append((text or "").encode())
                size += len(texts[-1])
                if size >= _BLOCK:
                    yield packed()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield packed()

    # Every later step must see the blocks alike, so they are written first.
    return stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, names), "packed", "none")


def _covered(texts: list[bytes], block: Block, recurring: np.ndarray) -> list[np.ndarray | None]:
    """For each text, which of its words lie under a recurring passage, as the block's automaton finds them."""
    width, words = block.width, block.words
    starts = np.sort(recurring)
    out: list[np.ndarray | None] = [None] * len(texts)
    if not len(starts):
        return out
    # Tiles of each run of recurring windows: every width-th one and the last.
    run = np.concatenate([[0], np.cumsum((np.diff(starts) > 1) | (words.text[starts[1:]] != words.text[starts[:-1]]))])
    first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
    offset = starts - starts[first][run]
    last = np.concatenate([np.diff(run) > 0, [True]])
    tiles = starts[(offset % width == 0) | last]
    split: dict[int, list[bytes]] = {}
    codes: dict[bytes, int] = {}
    tile_text = words.text[tiles].tolist()
    pair = len(np.unique(words.hash)) > 1_000_000  # more words than single characters

    def character(code: int) -> str:
        if pair:
            return chr(0x10000 + code // 0x80000) + chr(0x20000 + code % 0x80000)
        return chr(0xE000 + code if code < 0x1900 else 0x10000 + code - 0x1900)

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for tile, text in zip(tiles.tolist(), tile_text, strict=True):
        own = split.get(text)
        if own is None:
            own = split[text] = texts[text].split()
        at = tile - int(words.first[text])
        automaton.add_word("".join(character(codes.setdefault(w, len(codes))) for w in own[at : at + width]))
    automaton.make_automaton()
    unit = 2 if pair else 1
    other = "\x01" * unit
    symbols = {w: character(c) for w, c in codes.items()}
    for text, raw in enumerate(texts):
        if words.count[text] < width:
            continue
        own = split.get(text) or raw.split()
        ends = np.array([e for e, _ in automaton.iter("".join([symbols.get(w, other) for w in own]))], np.int64)
        if len(ends):
            ends = (ends + 1) // unit
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, ends - width, 1)
            np.add.at(edge, ends, -1)
            out[text] = np.cumsum(edge[:-1]) > 0
    return out


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row; with ``with_text`` also ``kept``, the words left."""
    spark = docs.sparkSession
    blocks = _pack(docs)
    n_blocks = blocks.count()
    # A block sends at most about 0.7 MB of anchors and 12 MB of windows; a part gets some tens of MB.
    parts_1, parts_2 = (max(partitions(spark), n_blocks * mb // 24) for mb in (1, 8))
    result = _RESULT + (", kept string" if with_text else "")

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.table(batch.slice(i, 1))
                yield _sent(row["block"][0].as_py(), *Block(_opened(row)[1], width, gram).anchors(), parts_1)

    def opened(left: pa.Table, right: pa.Table) -> tuple[list, list[bytes], Block, tuple, list[tuple]]:
        ids, texts = _opened(left)
        block = Block(texts, width, gram)
        rows = list(zip(*(right[c].to_pylist() for c in ("step", "part", "n", "recurs")), strict=True))
        anchors = block.anchors()[0]
        return ids, texts, block, block.windows(anchors[_bits([r[1:] for r in rows if r[0] == 1])]), rows

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, _, windows, _ = opened(left, right)
        return pa.Table.from_batches([_sent(left["block"][0].as_py(), *windows[:3], parts_2)])

    def locate(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts, block, windows, rows = opened(left, right)
        recurs = _bits([r[1:] for r in rows if r[0] == 2])
        covered = _covered(texts, block, windows[3][recurs[block.group]] if len(windows[3]) else windows[3])
        out = []
        for doc_id, text, mask, n in zip(ids, texts, covered, block.words.count.tolist(), strict=True):
            words = text.split()
            kept = b" ".join(words if mask is None else [w for w, gone in zip(words, mask.tolist(), strict=True) if not gone])
            out.append((doc_id, n, 0 if mask is None else int(mask.sum()), hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())[: 5 if with_text else 4]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], [x.split()[0] for x in result.split(", ")])

    empty = blocks.select("block", F.lit(0).alias("step"), F.lit(0).alias("part"), F.lit(0).alias("n"), F.lit(b"").alias("recurs"))
    step = lambda answer, k: answer.select("block", F.lit(k).alias("step"), "part", "n", "recurs")
    first = step(stage(_recurring(blocks.mapInArrow(send_anchors, _SENT)), "anchors"), 1)
    sent = blocks.groupBy("block").cogroup(first.unionByName(empty).groupBy("block")).applyInArrow(send_windows, _SENT)
    second = step(stage(_recurring(sent), "windows"), 2)
    return blocks.groupBy("block").cogroup(first.unionByName(second).unionByName(empty).groupBy("block")).applyInArrow(locate, result)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
m AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
g AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM s WHERE h IN (SELECT h FROM m)),
x AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.p) AS kept, count(*) AS n FROM x LEFT JOIN g ON x.r = g.r AND x.p = g.p WHERE g.r IS NULL GROUP BY x.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r
"""
