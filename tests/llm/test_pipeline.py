from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from stratamart.llm import decontamination, mixing, pii, registry, toxicity

from .test_dedup import brute_links
from .test_filters import brute_spans
from .test_models import brute_targets


def contaminated(text, items):
    windows = set()
    for item in items:
        w = decontamination.words_of(item)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12) if w else 0)}
    words, hit = decontamination.words_of(text), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_pipeline_equals_brute_force(spark, sf, tmp_path):
    """Each stage on its own input against a plain version of it; the toxicity model is asked, not rebuilt."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, [{r.doc_id: r for r in docs.collect()}]
    for k, (_, apply) in enumerate(corpus_pipeline.STAGES[:-1]):
        apply(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        seen.append({r.doc_id: r for r in docs.collect()})
    first, clean, single, untested, redacted = seen

    model, _ = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert set(clean) == {i for i, r in first.items() if model.score(r.text) < 0.7}

    rows = sorted((i, r.text) for i, r in clean.items())
    _, roots = brute_links(rows)
    assert set(single) == {rows[k][0] for k, root in enumerate(roots) if root == k}

    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(untested) == {i for i, r in single.items() if not contaminated(r.text, items)}

    assert set(redacted) == set(untested)
    for i, r in redacted.items():
        spans = brute_spans(untested[i].text)
        assert r.text == pii.redact_text(untested[i].text, spans) and r.n_chars == (len(r.text) if spans else untested[i].n_chars)

    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in redacted.values():
        n = len((r.text or "").encode().split())
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    for r in mixed:
        assert r.text == redacted[r.doc_id].text and 1 <= r.repetition <= 3
        taken[r.source] += len(r.text.encode().split())
    assert all(abs(taken[s] - t) <= longest[s] for s, t in brute_targets(sizes).items())
    assert sorted((r.doc_id, r.repetition) for r in mixed) == sorted((r.doc_id, k) for r in mixing.mix(docs).collect() for k in range(1, r.copies + 1))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = registry.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(c[0] for c in con.execute(registry.ORACLE_SQL[name]).description)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    plain = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert plain(got.select(*columns).collect()) == plain(expected)


# Names that the stages use inside, as columns of the caller.
INNER = [
    "whole", "last_key", "plan_source", "plan", "size", "source_size", "target", "copies", "repetition", "toxicity", "score", "v_id", "v_key", "key",
    "bad_id", "bad_key", "class_id", "kept", "repeated", "text_key", "contaminated", "found", "hit", "words", "spans", "codes", "root", "node",
]


def run_stages(spark, docs, sf, folder):
    """The stages as ``run`` applies them, on other documents."""
    for k, (_, apply) in enumerate(corpus_pipeline.STAGES):
        apply(spark, docs, sf).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


def test_columns_of_any_name_pass_through_every_stage(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    extra = docs.selectExpr("*", *[f"concat('{name} ', doc_id) AS {name}" for name in INNER])
    plain = {(r.doc_id, r.repetition): r for r in run_stages(spark, docs, sf, str(tmp_path / "plain")).collect()}
    found = run_stages(spark, extra, sf, str(tmp_path / "extra")).collect()
    assert {(r.doc_id, r.repetition_) for r in found} == set(plain) and len(found) == len(plain) > 0
    for r in found:
        assert r.text == plain[r.doc_id, r.repetition_].text
        assert all(r[name] == f"{name} {r.doc_id}" for name in INNER)


def test_pipeline_of_odd_documents(spark, documents, no_documents, sf, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows; and no documents at all."""
    found = run_stages(spark, documents, sf, str(tmp_path / "odd")).collect()
    kept = {(r.doc_id, r.text) for r in found}
    assert {1, 4, 9} <= {i for i, _ in kept} and not {2, 3} & {i for i, _ in kept}
    assert all(1 <= r.repetition <= 3 for r in found) and len({(r.doc_id, r.text, r.repetition) for r in found}) == len(found)
    assert run_stages(spark, no_documents, sf, str(tmp_path / "none")).count() == 0


def test_matches_keep_null_ids(spark, no_documents):
    docs = spark.createDataFrame([(None, "alpha beta gamma"), (3, "alpha beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([("1", "alpha beta gamma")], "item_id string, text string")
    assert sorted(decontamination.matches(docs, items).collect(), key=repr) == [(3, "1", 0, 2), (None, "1", 0, 2)]
