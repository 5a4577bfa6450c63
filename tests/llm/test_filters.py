import hashlib
import re

import pytest
from pyspark.sql import functions as F

from stratamart.llm import decontamination, licences, pii, toxicity, url_filter

from .conftest import DOCS, doc, phrase

ITEMS = "item_id long, text string"


def brute_hits(text, items):
    words, hit, used = decontamination.words_of(text), set(), set()
    for item_id, item in items:
        w = decontamination.words_of(item)
        for i in range(max(1, len(w) - 12) if w else 0):
            window = w[i : i + 13]
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    used.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(used)).encode()).hexdigest()
    return len(words), len(hit), len(used), digest, len(hit) > 0 and 20 * len(hit) >= len(words)


def test_contamination_equals_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 500)
    items = [(1, phrase(2, 20)), (2, phrase(2, 20)), (30, "One, TWO!"), (4, None), (5, "..."), (6, phrase(3, 14)), (7, "w2 " + phrase(1, 13))]
    extra = spark.createDataFrame([doc(50, phrase(3, 13) + " " + phrase(77, 400)), doc(51, "x-" + phrase(2, 13).upper() + "; y"), doc(52, "ÄÖ one   two")], DOCS)
    df = documents.unionByName(extra).filter("doc_id IS NOT NULL")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    expected = sorted((i, *brute_hits(t, items)) for i, t in rows)
    found = decontamination.contamination(df, spark.createDataFrame(items, ITEMS)).drop("text_key")
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert any(r[-1] for r in expected) and not all(r[-1] for r in expected)


def test_decontaminate_keeps_clean_rows(spark, documents, no_documents):
    items = spark.createDataFrame([(1, phrase(2, 20))], ITEMS)
    left = decontamination.decontaminate(documents, items)
    assert left.columns == documents.columns and left.count() == documents.count() - 2
    none = spark.createDataFrame([], ITEMS)
    assert decontamination.decontaminate(documents, none).count() == documents.count()
    assert decontamination.contamination(no_documents, items).count() == 0


def test_small_slices_find_what_one_slice_finds(spark, documents):
    """A benchmark beyond a slice, with items beyond a slice, equal windows in several slices and a document hit by many."""
    items = [(1, phrase(2, 40)), (2, phrase(2, 20)), (3, "One, TWO!"), (4, None), (5, phrase(3, 14)), (6, phrase(3, 13)), (7, phrase(2, 40))]
    benchmark = spark.createDataFrame(items, ITEMS)
    extra = spark.createDataFrame([doc(60, phrase(2, 40) + " " + phrase(3, 14) + " one two"), doc(61, phrase(2, 30))], DOCS)
    df = documents.unionByName(extra)
    shards = decontamination.index(df, 300)
    whole = sorted(map(repr, decontamination.judge(shards, benchmark).collect()))
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    brute = sorted(repr((i, *brute_hits(t, items))) for i, t in rows)
    assert sorted(repr(tuple(r)[:1] + tuple(r)[2:]) for r in decontamination.judge(shards, benchmark).collect()) == brute
    for slice_words in (1, 15, 33):
        slices = list(decontamination.query_slices(benchmark, slice_words=slice_words))
        assert len(slices) > 3 and all(len(q.terms) <= max(13, slice_words) for q in slices)
        assert sorted(map(repr, decontamination.judge(shards, benchmark, slice_words=slice_words).collect())) == whole
    exact = sorted(map(repr, decontamination.matches(df, benchmark).collect()))
    assert sorted(map(repr, decontamination.matches(df, benchmark, slice_words=15).collect())) == exact


def test_phrase_and_proximity_matches(spark):
    df = spark.createDataFrame([doc(1, "a b c d"), doc(2, "a x b c d"), doc(3, "b a c d"), doc(4, "z a x y b")], DOCS)
    items = spark.createDataFrame([(1, "a b"), (2, "c d")], ITEMS)
    exact = {tuple(r) for r in decontamination.matches(df, items).collect()}
    assert exact == {(1, "1", 0, 1), (1, "2", 2, 3), (2, "2", 3, 4), (3, "2", 2, 3)}
    near = {tuple(r) for r in decontamination.matches(df, items, slop=1).collect()}
    assert near == exact | {(2, "1", 0, 2)}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TEXTS = [
    None, "", "a@b.c@d.e x@y a.b+c@d-e.f.g. @x.y", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
    "+1 (555) 123-4567 +12 + 1234567 +49.30.1234567890123456789", "é4111111111111111ü ünïcode@ex.com 9" * 3, "0" * 9000 + ".1.2.3", "a" * 30000, "@" * 2000 + ".",
]


def brute_spans(text):
    text, digits = text or "", lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_plain_patterns():
    for text in TEXTS:
        assert [c[:3] for c in pii.candidates(text) if c[3]] == brute_spans(text), text


def test_spans_and_redaction(spark, no_documents):
    rows = [doc(k, t) for k, t in enumerate(TEXTS)] + [doc(99, "write to kim.lee (at) example (dot) com today, or mail@x.org"), doc(98, "clean text 12 34")]
    df = spark.createDataFrame(rows, DOCS)
    found = pii.found_spans(df)
    assert found.count() == len(rows)
    cleaned = {r.doc_id: r for r in pii.redact(df).collect()}
    assert "[EMAIL]" in cleaned[99].text and "mail@x.org" not in cleaned[99].text and cleaned[99].n_chars == len(cleaned[99].text)
    assert cleaned[98].text == "clean text 12 34" and cleaned[98].n_chars == 16 and cleaned[0].text is None
    assert pii.redact(no_documents).count() == 0


def test_labelers_are_weighed_by_agreement():
    good, bad = ("phone", 0b011011, 0), ("phone", 0b000000, 0b111010)
    model = pii.SpanModel({good: 500, bad: 500, ("phone", 0b011010, 0): 20})
    assert model.accepts("phone", False, 0b011010, 0) and not model.accepts("phone", False, *bad[1:]) and model.accepts("card", True, 0, 0)
    assert not pii.SpanModel({}).accepts("card", False, 63, 0)
    assert pii.redact_text("ab cd ef", [("card", 3, 5), ("phone", 4, 8)]) == "ab [CARD]"


def test_toxicity_on_held_out_rows(spark):
    foul = ("grubble", "snark", "vexatious")
    rows, labels = [], []
    for k in range(600):
        bad = k % 6 == 0
        text = phrase(k + 1000, 40) + (f" {foul[k % 3]} and {foul[(k + 1) % 3]}" if bad else "")
        rows.append(doc(k, text))
        labels.append((k, 1, int(bad)))
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model, hits = toxicity.train(df, lab)
    assert hits.count() == 600
    scored = {r.doc_id: r for r in toxicity.scores(df, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    held = [k for k in range(600) if scored[k].held]
    assert held and all((scored[k].toxicity >= 0.7) == (k % 6 == 0) for k in held)
    odd = spark.createDataFrame([doc(1, None), doc(2, ""), doc(3, "GRUBBLE snark"), doc(4, "x " * 50_000)], DOCS).selectExpr("*", "5 AS toxicity")
    out = {r.doc_id: r.toxicity for r in toxicity.scores(odd, model).collect()}
    assert out[1] < 0.7 and out[2] == out[1] and out[3] >= 0.7 and out[4] < 0.7
    kept = toxicity.reject_toxic(df, lab)
    assert kept.columns == df.columns and kept.count() == 500


def test_toxicity_without_labels_or_rows(spark, documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.reject_toxic(documents, none).count() == documents.count()
    assert toxicity.reject_toxic(no_documents, none).count() == 0


PAGES = "page_id long, url string, html string"
URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/1?x=/de/", "https://example.net", "https://x.net/", "http://badexample.com/de/", "http://example.com/de/a#b",
    "http://www.example.com/de", "http://a.org/fr/x", "http://org/fr/", "http://a.org?/fr/", "x://y://net/", "ftp://net/deep/path", "http://a.b.example.com/de/q", "http://example.net/en/",
]


def brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")


@pytest.mark.parametrize("max_bytes", [256_000_000, 0])
def test_url_rules_equal_brute_force(spark, max_bytes):
    rules = [*url_filter.RULES, ("a.org", "/fr/x", "block"), ("b.example.com", "", "allow"), *((f"h{k}.com", "/", "block") for k in range(300))]
    urls = URLS + [f"http://sub.h{k}.com/q" for k in range(0, 600, 7)]
    df = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)], PAGES).selectExpr("*", "1 AS host", "2 AS rule")
    got = url_filter.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"), max_bytes)
    assert sorted(tuple(r) for r in got.collect()) == [(k, *brute_rule(u, rules)) for k, u in enumerate(urls)]


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS", 2)  # many mistakes, so several levels
    listed, universe = [f"k{i}" for i in range(0, 4000, 3)], [f"k{i}" for i in range(4000)]
    keys = lambda x: spark.createDataFrame([(k,) for k in x], "key string")
    cascade = url_filter.build(keys(listed), keys(universe + universe[:50]))
    assert len(cascade.levels) > 2
    rows = url_filter._hashed(keys(universe)).toPandas()
    said = set(rows.key[cascade.listed(rows.h1.to_numpy(), rows.h2.to_numpy())])
    assert said == set(listed)
    assert url_filter.judge(spark.createDataFrame([], PAGES), spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")).count() == 0


def test_licences(spark, documents, no_documents):
    mit = licences.KNOWN[0][1]
    varied = "Copyright (c) 2020 Somebody\n" + mit.upper().replace("LICENSE", "LICENCE").replace(",", " ;") + "\n\n(c) All others"
    rows = [doc(1, mit), doc(2, varied), doc(3, mit + " more"), doc(4, "Text here.\nreleased under the MIT licence\nReleased under the MIT License."), doc(5, "Copyright 2020 me"), doc(6, None), doc(6, None)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS licence", "2 AS notices")
    known = spark.createDataFrame(list(licences.KNOWN), "licence string, text string")
    got = {r.doc_id: r for r in licences.scan(df, known).collect()}
    assert got[1].licence == got[2].licence == "MIT" and got[1].canonical_sha256 == got[2].canonical_sha256
    assert got[3].licence is None and (got[4].n_notices, got[4].notices) == (2, "MIT")
    assert got[5].canonical_sha256 is None and got[6].canonical_sha256 is None and len(got) == 6
    assert licences.scan(df, known).count() == 7 and licences.scan(no_documents, known).count() == 0
    plan = licences.scan(df, known)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_notices_of_any_words_are_found(spark):
    """Known texts without the usual words, and texts that only a respelling makes equal."""
    known = spark.createDataFrame(
        [("A", "Free for all"), ("B", "sublicense"), ("C", "https"), ("D", "The favor of copyright holder"), ("E", "  ,"), ("F", None), ("G", "f\u00fcr alle")],
        "licence string, text string",
    )
    lines = ["FREE, for: all!", "sub licence", "Sub-License", "http", "the FAVOUR of copyright  owner", "free for all of us", "F\u00fcr alle", "", "none of it"]
    df = spark.createDataFrame([doc(1, "\n".join(lines)), doc(2, None), doc(3, ""), doc(4, "HTTP")], DOCS)
    got = {row.doc_id: (row.licence, row.n_notices, row.notices) for row in licences.scan(df, known).collect()}
    assert got == {1: (None, 6, "A,B,C,D,G"), 2: (None, 0, ""), 3: (None, 0, ""), 4: ("C", 1, "C")}
    assert licences.scan(df, known.where("false")).agg({"n_notices": "sum"}).first()[0] == 0


def test_telling_words_lose_no_line(spark, monkeypatch):
    known = spark.createDataFrame(list(licences.KNOWN), "licence string, text string")
    assert licences.telling_words(known) is not None
    text = "\n".join(["x " * 3, *(t for _, t in licences.KNOWN), *(t.lower().replace("license", "licence") for _, t in licences.KNOWN)])
    df = spark.createDataFrame([doc(1, text)], DOCS)
    chosen = licences.scan(df, known).collect()
    monkeypatch.setattr(licences, "WORDS_BYTES", 0)
    assert licences.telling_words(known) is None and licences.scan(df, known).collect() == chosen
    assert chosen[0].n_notices == 2 * len(licences.KNOWN)


def test_whole_texts_of_permissive_licences(spark):
    rows = [doc(i, "Copyright (c) 1999, Some Body\n" + text) for i, (_, text) in enumerate(licences.KNOWN)]
    known = spark.createDataFrame(list(licences.KNOWN), "licence string, text string")
    got = {row.doc_id: row.licence for row in licences.scan(spark.createDataFrame(rows, DOCS), known).collect()}
    assert got == {i: name for i, (name, _) in enumerate(licences.KNOWN)}
