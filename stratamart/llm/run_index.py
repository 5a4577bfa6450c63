"""Suffix-array dedup over a run-length index: long byte matches with earlier documents.

Every window of ``WIDTH`` bytes has an anchor, its ``GRAM``-byte piece of smallest hash, so equal windows have equal
anchors wherever they stand. Anchors only say which texts have to meet; the index decides.

1. Texts are packed into blocks of a few MB. Each block sends 32 bits of each distinct anchor,
   dealt by hash range, and gets back: does it recur, and is it frequent (``HEAVY``)?
2. Around recurring anchors a block cuts pieces (up to 27 consecutive windows of one anchor). Equal pieces of a block
   are sent once, with their smallest document, to the shard of their anchor's range. Pieces of a
   frequent anchor are cut into single windows dealt by their own hash, so no anchor fills a shard.
3. A shard builds run-length indexes (:class:`RunIndex`) of some 200,000 symbols: the Burrows-Wheeler transform
   of its texts, kept as runs, with the smallest document sampled at run ends. All texts are streamed
   through it from right to left; matching statistics are held at ``WIDTH`` bytes by widening the range of rows by one
   symbol before each step. The window is removed where the sample at the end of its range is a smaller document.
4. A block gets back one mask for each of its pieces, and cuts its texts.

No window, however common, meets in one task: a block sends each text once. Nothing is collected. A text is
handled in one task, at about 15 bytes of memory a byte.

Defined cases: a null or empty text has no bytes; a text shorter than ``WIDTH`` keeps all of them; a null
doc_id counts as greater than all others; rows of equal doc_id are no earlier documents for each other; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import partitions, stage, table
from stratamart.llm.hashing import mix
from stratamart.llm.substring_dedup import _bits as bits_of
from stratamart.llm.substring_dedup import _opened as opened
from stratamart.llm.substring_dedup import _pack as pack

WIDTH = 50
GRAM = 24
SPAN = WIDTH - GRAM + 1
HEAVY = 10_000
INDEX_SYMBOLS = 200_000
_SEGMENT = 1_000_000
_LAST = np.iinfo(np.int64).max
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_ANCHORS = "part int, block long, n int, hashes binary, many binary, counts binary"
_ANSWER = "block long, part int, n int, recurs binary, heavy binary"
_PIECES = "part int, block long, n int, texts binary, sizes binary, keys binary, docs binary"
_MASKS = "block long, part int, n int, masks binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _grams(raw: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive bytes."""
    if len(raw) < n:
        return np.zeros(0, _U)
    power = raw.astype(_U) + _U(1)
    out, done, size, left = None, 0, 1, n
    while left:
        if left & 1:
            m = len(raw) - done - size + 1
            out = power if out is None else out[:m] * _U(pow(_STEP, size, 1 << 64)) + power[done : done + m]
            done += size
        left >>= 1
        if left:
            power = power[:-size] * _U(pow(_STEP, size, 1 << 64)) + power[size:]
            size *= 2
    return mix(out)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _pieces(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) of the runs of up to ``SPAN`` consecutive windows with one anchor; none leaves its text."""
    n = len(raw) - WIDTH + 1
    edge = np.zeros(len(raw) + 1, np.int8)
    long = sizes >= WIDTH
    edge[(np.cumsum(sizes) - sizes)[long]] = 1
    edge[np.cumsum(sizes)[long] - WIDTH + 1] -= 1
    inside = np.cumsum(edge, dtype=np.int8)[: max(0, n)] > 0
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U))]
    for a in range(0, n, _SEGMENT):
        b = min(a + _SEGMENT, n)
        anchor = _sliding_min(_grams(raw[a : b + WIDTH - 1], GRAM), SPAN)
        at = np.flatnonzero(inside[a:b])
        anchor = anchor[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(first, append=len(at))
        cuts = -(-count // SPAN)
        again = np.repeat(np.arange(len(first)), cuts)
        part = np.arange(len(again)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        # Anchors are small hashes; mixed again, they spread over all ranges.
        out.append((at[first][again] + a + part * SPAN, np.minimum(SPAN, count[again] - part * SPAN), mix(anchor[first][again])))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def _dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each hash its part, by range, and 32 bits that tell it from others of the part."""
    low = (hashes & _U(0xFFFFFFFF)) * _U(parts) >> _U(32)
    scaled = (hashes >> _U(32)) * _U(parts) + low
    return (scaled >> _U(32)).astype(np.int64), scaled.astype(np.uint32)


def _row(values: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    kind = [kinds[x.split()[1]] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in values], t) for i, t in enumerate(kind)], _names(schema))


class Block:
    """A packed block of texts and its pieces."""

    def __init__(self, row: pa.Table):
        self.number = row["block"][0].as_py()
        self.ids, texts = opened(row)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.bytes = b"".join(texts)
        self.raw = np.frombuffer(self.bytes, np.uint8)
        self.start, self.count, self.anchor = _pieces(self.raw, self.sizes)
        self.docs = np.array([_LAST if i is None else i for i in self.ids], np.int64)

    def text_of(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.cumsum(self.sizes), start, "right")

    def anchors(self, parts: int) -> pa.RecordBatch:
        order = np.argsort(self.anchor, kind="stable")
        value, text = self.anchor[order], self.text_of(self.start[order])
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
        count = np.minimum(np.diff(first, append=len(value)), 0xFFFF).astype(np.uint16)
        many = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first) if len(first) else np.zeros(0, bool)
        part, short = _dealt(value[first], parts)
        cuts = np.searchsorted(part, np.arange(parts + 1))
        rows = [
            (p, self.number, int(b - a), short[a:b].tobytes(), np.packbits(many[a:b]).tobytes(), count[a:b].tobytes())
            for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a
        ]
        return _row(rows, _ANCHORS)

    def recurring(self, recurs: np.ndarray, heavy: np.ndarray) -> None:
        """Keep the pieces that need looking up: their places, contents, keys and each content's smallest document."""
        which = np.unique(self.anchor, return_inverse=True)[1]
        chosen = recurs[which] if len(which) else np.zeros(0, bool)
        single = chosen & heavy[which] if len(which) else chosen
        plain = chosen & ~single
        count = self.count[single]
        again = np.repeat(np.arange(len(count)), count)
        windows = self.start[single][again] + np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
        self.start = np.concatenate([self.start[plain], windows])
        self.count = np.concatenate([self.count[plain], np.ones(len(windows), np.int64)])
        keys = np.concatenate([self.anchor[plain], self._window_hashes(windows)])
        seen: dict[bytes, int] = {}
        ends = self.start + self.count + WIDTH - 1
        code = np.array([seen.setdefault(self.bytes[a:b], len(seen)) for a, b in zip(self.start.tolist(), ends.tolist(), strict=True)], np.int64)
        self.own = self.docs[self.text_of(self.start)]
        first, key = np.full(len(seen), _LAST), np.zeros(len(seen), _U)
        np.minimum.at(first, code, self.own)
        key[code] = keys
        order = np.argsort(key, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        texts = list(seen)
        self.texts, self.key, self.first, self.code = [texts[i] for i in order.tolist()], key[order], first[order], place[code]

    def _window_hashes(self, starts: np.ndarray) -> np.ndarray:
        powers = np.array([pow(_STEP, WIDTH - 1 - i, 1 << 64) for i in range(WIDTH)], _U)
        out = np.zeros(len(starts), _U)
        for a in range(0, len(starts), 50_000):
            own = self.raw[starts[a : a + 50_000, None] + np.arange(WIDTH)].astype(_U) + _U(1)
            out[a : a + 50_000] = mix((own * powers).sum(1))
        return out

    def pieces(self, parts: int) -> pa.RecordBatch:
        part, _ = _dealt(self.key, parts)
        cuts = np.searchsorted(part, np.arange(parts + 1)).tolist()
        sizes = np.array([len(t) for t in self.texts], np.uint8)
        squeeze = zstandard.ZstdCompressor(level=3)
        rows = [
            (p, self.number, b - a, squeeze.compress(b"".join(self.texts[a:b])), sizes[a:b].tobytes(), self.key[a:b].tobytes(), self.first[a:b].tobytes())
            for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a
        ]
        return _row(rows, _PIECES)

    def results(self, masks: np.ndarray, with_text: bool) -> pa.Table:
        """One row a text; ``masks`` tells the removed windows of each content for its smallest document."""
        whole = ((1 << self.count) - 1).astype(np.uint32)
        mask = np.where(self.own > self.first[self.code], whole, masks[self.code]) if len(self.code) else whole
        piece, window = np.nonzero(mask[:, None] >> np.arange(SPAN, dtype=np.uint32) & 1)
        starts = self.start[piece] + window
        edge = np.zeros(len(self.raw) + 1, np.int32)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + WIDTH, -1)
        gone = np.cumsum(edge[:-1]) > 0
        rows, at = [], 0
        for doc_id, size in zip(self.ids, self.sizes.tolist(), strict=True):
            own = gone[at : at + size]
            removed = int(own.sum())
            kept = self.raw[at : at + size][~own].tobytes() if removed else self.bytes[at : at + size]
            spans = int((np.diff(own.astype(np.int8), prepend=0) == 1).sum()) if removed else 0
            rows.append((doc_id, size, removed, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
            at += size
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [*_names(_RESULT), *["kept"] * with_text])


class RunIndex:
    """A run-length index over ``texts``, whose documents are ``docs``.

    Rows are the suffixes in the order of their first ``WIDTH`` symbols (each text ends with a smaller symbol than all
    bytes); this order suffices for backward steps up to ``WIDTH`` symbols. Runs of equal preceding
    symbols end also where the first ``WIDTH`` symbols of the suffixes change, so that the run end of a group can hold
    the group's smallest document.
    """

    def __init__(self, texts: list[bytes], docs: np.ndarray):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1
        self.sizes, self.docs, self.n = sizes, docs, int(self.ends[-1]) + 1
        self.symbols = np.zeros(self.n, np.int64)
        self.symbols[np.arange(sizes.sum()) + np.repeat(np.arange(len(texts)), sizes)] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        order, new, wide = self._sorted()
        before = self.symbols[order - 1]
        starts = np.flatnonzero(new | np.append(True, before[1:] != before[:-1]))
        groups = np.flatnonzero(new)
        smallest = np.minimum.reduceat(np.repeat(docs, sizes + 1)[order], groups)
        # By row: the number of its run, and the rows that share its first WIDTH - 1 symbols.
        self.run = np.cumsum(np.bincount(starts, minlength=self.n)).astype(np.int32) - 1
        self.sample = smallest[np.searchsorted(groups, starts, "right") - 1]
        self.wide_start = np.flatnonzero(wide)
        self.wide_end = np.append(self.wide_start[1:], self.n)
        self.wide = np.cumsum(wide).astype(np.int32) - 1
        # Runs by symbol and row; running lengths in that order are the rows backward steps lead to.
        length = np.diff(starts, append=self.n)
        by = np.argsort(before[starts] * (self.n + 1) + starts, kind="stable")
        self.run_symbol, self.run_start, self.run_length = before[starts][by], starts[by], length[by]
        self.run_key = self.run_symbol * (self.n + 1) + self.run_start
        self.run_before = np.cumsum(self.run_length) - self.run_length
        # The same by row order: each run's symbol, end, and how far a backward step by that symbol leads.
        self.symbol, self.end = before[starts], starts + length
        self.step = np.empty(len(starts), np.int64)
        self.step[by] = self.run_before - self.run_start

    def _sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows in order; which differ from the row before in their first WIDTH, and in their first WIDTH - 1 symbols."""
        n, last = self.n, WIDTH - 1
        rank, known = _ranks(self._packed(7)), 7
        while known * 2 <= last:
            rank, known = _ranks(rank * (n + 1) + _later(rank, known)), known * 2
        whole = rank * (n + 1) + _later(rank, WIDTH - known)
        order = np.argsort(whole)
        new = np.append(True, np.diff(whole[order]) != 0)
        short = _later(rank, last - known)[order]
        return order, new, np.append(True, (np.diff(rank[order]) != 0) | (np.diff(short) != 0))

    def _packed(self, k: int) -> np.ndarray:
        padded = np.append(self.symbols, np.zeros(k, np.int64))
        out = np.zeros(self.n, np.int64)
        for i in range(k):
            out = out << 9 | padded[i : self.n + i]
        return out

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows below which the suffixes stand that put ``symbol`` before those below ``row``."""
        at = np.searchsorted(self.run_key, symbol * (self.n + 1) + row) - 1
        own = np.where(self.run_symbol[at] == symbol, np.minimum(row - self.run_start[at], self.run_length[at]), self.run_length[at])
        return np.where(at >= 0, self.run_before[at] + own, 0)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of rows that put ``symbol`` before those of the suffixes in [low, high)."""
        run = self.run[low]
        down, up = low + self.step[run], high + self.step[run]
        # A range that lies in one run of the symbol moves as a whole; the others are counted.
        rest = np.flatnonzero((self.symbol[run] != symbol) | (high > self.end[run]))
        down[rest], up[rest] = self.back(symbol[rest], low[rest]), self.back(symbol[rest], high[rest])
        return down, up

    def earlier(self) -> np.ndarray:
        """For each text a mask of the windows that occur in a text of a smaller document."""
        order = np.argsort(-self.sizes, kind="stable")
        sizes, ends, docs = self.sizes[order], self.ends[order], self.docs[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.n)
        masks = np.zeros(len(order), np.uint32)
        for t in range(int(sizes[0])):
            m = int(np.searchsorted(-sizes, -t, "left"))
            low, high = low[:m], high[:m]
            if t >= WIDTH:
                group = self.wide[low]
                low, high = self.wide_start[group], self.wide_end[group]
            symbol = self.symbols[ends[:m] - 1 - t]
            low, high = self.extend(symbol, low, high)
            if t >= WIDTH - 1:
                found = self.sample[self.run[high - 1]] < docs[:m]
                masks[:m] |= found.astype(np.uint32) << (sizes[:m] - 1 - t).astype(np.uint32)
        out = np.empty_like(masks)
        out[order] = masks
        return out


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(1, np.diff(keys[order]) != 0))
    return out


def _later(rank: np.ndarray, by: int) -> np.ndarray:
    return np.append(rank[by:], np.zeros(min(by, len(rank)), np.int64))


def _recurring(sent: DataFrame) -> DataFrame:
    """For each block: which of its anchors recur in other texts, and which are frequent."""

    def compare(group: pa.Table) -> pa.Table:
        n = group["n"].to_numpy()
        value = np.frombuffer(b"".join(group["hashes"].to_pylist()), np.uint32)
        count = np.frombuffer(b"".join(group["counts"].to_pylist()), np.uint16).astype(np.int64)
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=int(k)) for m, k in zip(group["many"].to_pylist(), n, strict=True)]).astype(bool)
        order = np.argsort(value, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(value[order]) != 0))
        places = np.diff(first, append=len(value))
        again = np.repeat(np.arange(len(first)), places)
        recurs, heavy = np.empty(len(value), bool), np.empty(len(value), bool)
        recurs[order] = ((places > 1) | np.logical_or.reduceat(many[order], first))[again]
        heavy[order] = (np.add.reduceat(count[order], first) >= HEAVY)[again]
        ends = np.cumsum(n)
        cut = lambda x: pa.array([np.packbits(x[e - k : e]).tobytes() for e, k in zip(ends, n, strict=True)], pa.binary())
        return pa.table([group["block"], group["part"], group["n"], cut(recurs), cut(heavy)], _names(_ANSWER))

    return sent.groupBy("part").applyInArrow(compare, _ANSWER)


def shard_masks(texts: list[bytes], keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The mask of each text's windows that occur in a smaller document; equal windows have equal keys."""
    masks = np.zeros(len(texts), np.uint32)
    order = np.argsort(keys, kind="stable")
    sizes = np.array([len(t) for t in texts], np.int64)
    # Indexes end where the key changes.
    number = np.cumsum(sizes[order]) // INDEX_SYMBOLS
    new = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    index_of = np.repeat(number[new], np.diff(new, append=len(order)))
    for rows in np.split(order, np.flatnonzero(np.diff(index_of)) + 1) if len(order) else []:
        seen: dict[bytes, int] = {}
        code = np.array([seen.setdefault(texts[i], len(seen)) for i in rows.tolist()], np.int64)
        first = np.full(len(seen), _LAST)
        np.minimum.at(first, code, docs[rows])
        found = RunIndex(list(seen), first).earlier()
        whole = ((1 << (sizes[rows] - WIDTH + 1)) - 1).astype(np.uint32)
        masks[rows] = np.where(docs[rows] > first[code], whole, found[code])
    return masks


def _answers(pieces: DataFrame) -> DataFrame:
    def search(group: pa.Table) -> pa.Table:
        squeezed, n = zstandard.ZstdDecompressor(), group["n"].to_numpy()
        texts: list[bytes] = []
        for blob, sizes in zip(group["texts"].to_pylist(), group["sizes"].to_pylist(), strict=True):
            own = np.frombuffer(sizes, np.uint8).astype(np.int64)
            raw, at = squeezed.decompress(blob, max_output_size=int(own.sum())), np.cumsum(np.append(0, own)).tolist()
            texts += [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        joined = lambda c, t: np.frombuffer(b"".join(group[c].to_pylist()), t)
        masks, ends = shard_masks(texts, joined("keys", _U), joined("docs", np.int64)), np.cumsum(n)
        cut = pa.array([masks[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)], pa.binary())
        return pa.table([group["block"], group["part"], group["n"], cut], _names(_MASKS))

    return pieces.groupBy("part").applyInArrow(search, _MASKS)


def remove_matches(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; with ``with_text`` also ``kept``, the bytes left."""
    spark = docs.sparkSession
    blocks = pack(docs)
    n_blocks = blocks.count()
    # A block sends about 1.5 MB of anchors and, as a rule, 2 to 5 MB of pieces; a part gets about 16 MB.
    parts_1, parts_2 = (max(partitions(spark), n_blocks * mb // 16) for mb in (2, 5))

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield Block(pa.table(batch.slice(i, 1))).anchors(parts_1)

    def looked_up(left: pa.Table, right: pa.Table) -> tuple[Block, list[tuple]]:
        block = Block(left)
        rows = list(zip(*(right[c].to_pylist() for c in ("part", "n", "recurs", "heavy", "masks")), strict=True))
        own = [r for r in rows if r[2] is not None]
        block.recurring(bits_of([(r[0], r[1], r[2]) for r in own]), bits_of([(r[0], r[1], r[3]) for r in own]))
        return block, rows

    def send_pieces(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches([looked_up(left, right)[0].pieces(parts_2)])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        block, rows = looked_up(left, right)
        masks = b"".join(m for _, m in sorted((r[0], r[4]) for r in rows if r[4] is not None))
        return block.results(np.frombuffer(masks, np.uint32), with_text)

    null = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    nothing = blocks.select("block", F.lit(0).alias("part"), F.lit(0).alias("n"), *null("recurs", "heavy", "masks"))
    anchors = stage(_recurring(blocks.mapInArrow(send_anchors, _ANCHORS)), "anchors").select("*", *null("masks")).unionByName(nothing)
    pieces = blocks.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(send_pieces, _PIECES)
    masks = stage(_answers(pieces), "masks").select("block", "part", "n", *null("recurs", "heavy"), "masks")
    return blocks.groupBy("block").cogroup(anchors.unionByName(masks).groupBy("block")).applyInArrow(cut, _RESULT + (", kept binary" if with_text else ""))


def op11_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_matches(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
c AS (SELECT r, id, b * 1000 AS o, substr(x, 2000 * b + 1, 2098) AS y FROM (SELECT r, id, x, unnest(range(0, len(x) // 2000 + 1)) AS b FROM d)),
w AS MATERIALIZED (SELECT r, id, o + i AS i, md5(substr(y, 2 * i + 1, 100)) AS h FROM (SELECT r, id, o, y, unnest(range(0, least(1000, len(y) // 2 - 49))) AS i FROM c)),
f AS (SELECT h, min(id) AS lo FROM w GROUP BY h),
s AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, true) AS new FROM w JOIN f USING (h) WHERE lo < id),
g AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM s) GROUP BY r, k),
p AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b, b - a AS gone FROM g
    UNION ALL SELECT d.r, coalesce(max(g.b), 0), len(any_value(d.x)) // 2, 0 FROM d LEFT JOIN g USING (r) GROUP BY d.r),
k AS (SELECT r, sum(gone) AS n_removed, count(*) - 1 AS n_spans, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b) AS kept FROM p JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM d JOIN k USING (r)
"""
