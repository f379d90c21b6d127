"""Each stage on its own input, against plain Python where that is possible."""

import pytest

import corpus_pipeline
from tests.llm.fixtures import clashing_documents, edge_documents, empty_documents, rows
from tests.llm.test_dedup import ascii_lower, plain_components, plain_sets
from tests.llm.test_training_data import check_packing, plain_ids


@pytest.fixture(scope="module")
def states(spark, sf):
    """The rows after every stage, the documents first."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stage(function(spark, out[-1], sf), "test"))
    return out


def test_stages_return_documents(states):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact duplicates", "near duplicates", "mixture", "packing"]
    for state in states[1:-1]:
        assert state.schema.simpleString() == states[0].schema.simpleString()


def test_quality_keeps_good_documents(states, spark, sf):
    labels = dict(rows(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "quality"))
    kept = {r[0] for r in rows(states[1], "doc_id")}
    assert all(i in kept for i, q in labels.items() if q == 1)
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i not in kept for i in bad) >= 0.7 * len(bad)


def test_exact_duplicates_go(states):
    best = {}
    for doc, text in rows(states[1], "doc_id", "text"):
        best[ascii_lower(text)] = max(doc, best.get(ascii_lower(text), doc))
    assert [r[0] for r in rows(states[2], "doc_id")] == sorted(best.values())


def test_near_duplicates_go(states):
    docs = rows(states[2], "doc_id", "text")
    ids = [d for d, _ in docs]
    expected = sorted(set(plain_components(ids, plain_sets([t for _, t in docs], 5), 80)))
    assert [r[0] for r in rows(states[3], "doc_id")] == expected


def test_mixture_has_its_words(states):
    before = sum(len(t.split()) for _, t in rows(states[3], "doc_id", "text"))
    after = rows(states[4], "doc_id", "text", "n_chars")
    assert abs(sum(len(t.split()) for _, t, _ in after) - 1.5 * before) <= 0.01 * before
    assert all(n == len(t) for _, t, n in after)
    texts = dict(rows(states[3], "doc_id", "text"))
    assert all(texts[i].startswith(t) for i, t, _ in after)


def test_packing_holds_all_tokens(states):
    ids_of = {}
    for doc, text in rows(states[4], "doc_id", "text"):
        ids_of.setdefault(doc, []).append([*plain_ids(text), 1])
    packed = states[5].collect()
    check_packing(packed, ids_of, 4096)
    assert sum(len(x) for docs in ids_of.values() for x in docs) == sum(p["length"] for p in packed)


@pytest.mark.parametrize("make", [edge_documents, clashing_documents, empty_documents])
def test_stages_take_edge_documents(spark, sf, make):
    docs = make(spark)
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, sf)
        assert out.count() >= 0
        if name != "packing":
            assert out.columns == docs.columns
            for column in set(docs.columns) - {"doc_id", "text", "lang", "source", "n_chars"}:
                assert out.filter(f"{column} != 'x' or {column} is null").count() == 0
