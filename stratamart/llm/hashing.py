"""Vectorised hashes of words and word sequences; equal in every task and run."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))


_SEGMENT = 1_000_000


def _hashed(raw: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word of ``raw``, which no word enters or leaves."""
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end, np.zeros(0, _U)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(size.sum(), dtype=np.int32) - np.repeat(first, size).astype(np.int32)
    powers = np.full(int(size.max()), _STEP, _U)
    powers[0] = 1
    sums = np.add.reduceat(_BYTE[raw[solid]] * np.cumprod(powers)[place], first)
    return start, end, mix(sums + size.astype(_U))


class Words:
    """The words of several texts: hashes, byte offsets, and where each text's words begin."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        raw = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
        solid = ~_SPACE[raw]
        parts, at = [], 0
        while at < len(raw):
            # Segments bound the working memory; they end at white space.
            stop = min(len(raw), at + _SEGMENT)
            while stop < len(raw) and solid[stop - 1]:
                stop += 1
            start, end, own = _hashed(raw[at:stop], solid[at:stop])
            parts.append((start + at, end + at, own))
            at = stop
        self.start, self.end, self.hash = (np.concatenate([p[i] for p in parts]) for i in range(3))
        self.first = np.searchsorted(self.start, np.cumsum(sizes) - sizes)
        self.count = np.diff(self.first, append=len(self.start))
        self.text = np.repeat(np.arange(len(texts)), self.count)


def runs(hashes: np.ndarray, n: int, step: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """Hash of each n consecutive words; empty where there are fewer."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, _U)
    for i in range(n if m else 0):
        out = out * _U(step) + hashes[i : i + m]
    return mix(out)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each run of n words within a text; a shorter text with words is one run."""
    value = runs(words.hash, n)
    text = words.text[: len(value)]
    inside = text == words.text[n - 1 :] if len(value) else np.zeros(0, bool)
    value, text = value[inside], text[inside]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        own = []
        for t in short:
            part = words.hash[words.first[t] : words.first[t] + words.count[t]]
            own.append(runs(part, len(part), 0x8CB92BA72F3D8DD7)[0])
        value, text = np.concatenate([value, np.array(own, _U)]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        value, text = value[order], text[order]
    return value, text
