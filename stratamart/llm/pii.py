"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone; fixed patterns with their checks) are always kept. Wider
patterns add candidates: obfuscated addresses, national telephone formats, identity
numbers, titled names, digit groups that fail a check. Regex, checksum, gazetteer,
context, boundary and format labelers vote yes, no or nothing on each. The votes of the
whole corpus, counted by pattern (a bounded table), go through expectation-maximisation
for the labelers' reliabilities and for a posterior of each pattern; a logistic span
classifier is trained on these and adds the candidates it is at least ``ACCEPT`` sure of.

Every pattern is linear in the text: addresses are extended from the ``@``, digit runs are
entered at their first digit only.

Defined cases: a null or empty text has no spans; offsets are code points, end exclusive;
repeated rows give equal results; an empty table gives an empty result; other columns pass
through :func:`redact` and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id", "name")
ACCEPT = 0.9
VOTERS = ("regex", "checksum", "gazetteer", "context", "boundary", "format")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NATIONAL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SPELLED = re.compile(r"([A-Za-z0-9._%+-]{1,64})(?: ?[(\[]at[)\]] ?| at )([A-Za-z0-9-]{1,63})(?: ?[(\[]dot[)\]] ?| dot )([A-Za-z]{2,24})(?![A-Za-z])")
_TITLED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau)\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?\b")

# Gazetteers and context words of the labelers.
_ENDINGS = frozenset("com org net edu gov info biz io de fr es uk eu us ca au ch at nl it".split())
_GIVEN = frozenset("James John Robert Michael William David Mary Patricia Jennifer Linda Anna Maria Peter Thomas Hans Claude Pierre Jean Marie Carlos Juan Jose Luis Carmen".split())
_COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91")
_NEAR = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "master", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "id": ("ssn", "social", "security", "identity", "passport"),
    "name": ("name", "dear", "contact", "signed", "author"),
}
_AGAINST = ("$", "€", "£", "#", "%", "version", "isbn", "page", "figure")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if place % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _part(text: str) -> bool:
    text = text.lstrip("0")
    return len(text) < 4 and int(text or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(spans that pass their check, matches that fail it), by kind and start."""
    good, bad = [("email", a, b) for a, b in _emails(text)], []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            (good if all(map(_part, m.groups())) else bad).append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19:
                (good if luhn(digits) else bad).append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            n = len(_digits(m[0]))
            (good if 8 <= n <= 15 else bad).append(("phone", *m.span()))
    return good, bad


def _wider(text: str, taken: list[Span]) -> list[Span]:
    found = []
    if "dot" in text:
        found += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        found += [("phone", *m.span()) for m in _NATIONAL.finditer(text)] + [("id", *m.span()) for m in _IDENTITY.finditer(text)]
    found += [("name", *m.span()) for m in _TITLED.finditer(text)]
    return [s for s in found if not any(a < s[2] and s[1] < b for _, a, b in taken)]


def _votes(text: str, span: Span, passed: bool | None) -> tuple[int, int]:
    """(bits of the labelers that say yes, of those that say no)"""
    kind, start, end = span
    own, before = text[start:end], text[max(0, start - 40) : start].lower()
    digits = _digits(own)
    says: list[bool | None] = [True if passed else None]
    says.append(passed if passed is not None else {"phone": len(digits) == 10, "id": digits[:3] not in ("000", "666") and digits[:1] != "9"}.get(kind))
    if kind == "email":
        says.append(own.rsplit(".", 1)[-1].rsplit(" ", 1)[-1].lower() in _ENDINGS or None)
    elif kind == "phone":
        says.append(digits.startswith(_COUNTRIES) if own.startswith("+") else None)
    elif kind == "card":
        says.append(digits[:1] == "4" or digits[:2] in ("34", "35", "37", "51", "52", "53", "54", "55", "62", "65") or digits[:4] == "6011")
    elif kind == "ip":
        says.append(False if digits[:1] == "0" else None)
    else:
        says.append((own.split()[1] in _GIVEN or None) if kind == "name" else None)
    says.append(True if any(w in before for w in _NEAR[kind]) else False if any(w in before[-12:] for w in _AGAINST) else None)
    says.append(not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()))
    says.append(None if kind in ("email", "ip", "name") else any(c in " ().-" for c in own) or kind == "card")
    return sum(1 << i for i, x in enumerate(says) if x is True), sum(1 << i for i, x in enumerate(says) if x is False)


def candidates(text: str | None) -> list[tuple[str, int, int, bool, int, int]]:
    """(kind, start, end, base, yes bits, no bits) of every span to be judged."""
    if not text:
        return []
    good, bad = base_spans(text)
    out = [(*s, True, *_votes(text, s, True)) for s in good]
    out += [(*s, False, *_votes(text, s, False)) for s in bad]
    return out + [(*s, False, *_votes(text, s, None)) for s in _wider(text, good + bad)]


class SpanModel:
    """Probability that a candidate is personal data, from its kind and votes."""

    def __init__(self, counts: dict[tuple[str, int, int], int]):
        self.weights = np.zeros(len(KINDS) + 2 * len(VOTERS))
        self.reliability: dict[str, np.ndarray] = {}
        patterns = sorted(counts)
        if not patterns:
            self.weights[: len(KINDS)] = -5
            return
        n = np.array([counts[p] for p in patterns], float)
        x = np.array([self._features(*p) for p in patterns])
        post = self._posterior(patterns, x[:, len(KINDS) :], n)
        for _ in range(30):
            p = self._squash(x @ self.weights)
            w = n * p * (1 - p)
            step = np.linalg.solve((x * w[:, None]).T @ x + 0.5 * np.eye(x.shape[1]), x.T @ (n * (post - p)) - 0.5 * self.weights)
            self.weights = self.weights + np.clip(step, -2, 2)

    @staticmethod
    def _squash(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    @staticmethod
    def _features(kind: str, yes: int, no: int) -> np.ndarray:
        bits = [*((yes >> i) & 1 for i in range(len(VOTERS))), *((no >> i) & 1 for i in range(len(VOTERS)))]
        return np.array([*(k == kind for k in KINDS), *bits], float)

    def _posterior(self, patterns: list[tuple[str, int, int]], votes: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
        """EM per kind: each labeler's rates of yes and no for true and false spans, with weak priors."""
        post = np.array([0.97 if p[1] & 1 else 0.1 if p[2] & 2 else 0.3 for p in patterns])
        kinds = np.array([p[0] for p in patterns])
        half = len(VOTERS)
        prior_true = np.concatenate([np.full(half, 0.6), np.full(half, 0.05)])
        prior_false = np.concatenate([np.full(half, 0.2), np.full(half, 0.4)])
        for kind in set(kinds):
            own = kinds == kind
            v, c = votes[own], n[own]
            for _ in range(rounds):
                q = post[own]
                one = ((c * q) @ v + 20 * prior_true) / ((c * q).sum() + 20)
                zero = ((c * (1 - q)) @ v + 20 * prior_false) / ((c * (1 - q)).sum() + 20)
                share = ((c * q).sum() + 1) / (c.sum() + 2)
                ratio = np.zeros(len(v))
                for i in range(half):
                    yes, no = v[:, i], v[:, half + i]
                    rest1, rest0 = max(1e-4, 1 - one[i] - one[half + i]), max(1e-4, 1 - zero[i] - zero[half + i])
                    ratio += yes * np.log(one[i] / zero[i]) + no * np.log(one[half + i] / zero[half + i]) + (1 - yes - no) * np.log(rest1 / rest0)
                post[own] = self._squash(ratio + np.log(share / (1 - share)))
            self.reliability[str(kind)] = np.stack([one, zero])
        return post

    def accepts(self, kind: str, base: bool, yes: int, no: int) -> bool:
        return base or bool(self._squash(self._features(kind, yes, no) @ self.weights) >= ACCEPT)

    def spans(self, found: list[tuple]) -> list[Span]:
        kept = {(k, a, b) for k, a, b, base, yes, no in found if self.accepts(k, base, yes, no)}
        return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_FOUND = "kinds array<string>, starts array<long>, ends array<long>, base array<boolean>, yes array<int>, no array<int>"


def found_spans(docs: DataFrame) -> DataFrame:
    """One pass over the texts: doc_id and the candidates of each row with their votes."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
    names = [x.split()[0] for x in _FOUND.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [candidates(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([[c[i] for c in r] for r in rows], pa.list_(t)) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, f"doc_id long, {_FOUND}"), "spans")


def fit(found: DataFrame) -> SpanModel:
    """The span model from the vote patterns of all candidates; at most 6 x 3**6 patterns reach the driver."""
    each = found.select(F.explode(F.arrays_zip("kinds", "yes", "no")).alias("x"))
    rows = each.groupBy("x.kinds", "x.yes", "x.no").agg(F.count(F.lit(1)).alias("n")).collect()
    return SpanModel({(r["kinds"], r["yes"], r["no"]): r["n"] for r in rows})


def redact_text(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``n_chars`` (if there) counted anew where that changed it."""
    model = docs.sparkSession.sparkContext.broadcast(fit(found_spans(docs)))

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact_text(t, s) if t and (s := model.value.spans(candidates(t))) else t)

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        changed = F.regexp_like("text", F.lit("\\[(EMAIL|IP|CARD|PHONE|ID|NAME)\\]"))
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_spans(table(spark, sf_dir, "documents"))
    model = fit(found)
    result = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for parts in zip(*(batch.column(i).to_pylist() for i in range(1, 7)), strict=True):
                own = list(zip(*parts, strict=True))
                base = sorted(((c[0], c[1], c[2]) for c in own if c[3]), key=lambda s: (KINDS.index(s[0]), s[1]))
                spans = model.spans(own)
                counts = [sum(s[0] == k for s in base) for k in BASE]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [x.split()[0] for x in result.split(", ")])

    return found.mapInArrow(judge, result)
