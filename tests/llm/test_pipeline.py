"""The stages against brute force, on their own inputs."""

import collections

import pytest

import corpus_pipeline as pipeline
from spanseek.llm import queries, secret_scan
from spanseek.staging import stage

from .helpers import documents, empty, odd
from .test_pairs import brute_print, union_find

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = documents(spark, "sf0.01")
    out = {"documents": docs}
    for name, function in pipeline.STAGES:
        docs = out[name] = stage(function(spark, docs, SF), name)
    return out


def test_columns_and_clean_documents_stay(stages):
    names = stages["documents"].columns
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name].columns == names
    assert stages["language_id"].count() == 1000
    assert stages["secret_scan"].count() == stages["decontamination"].count() == stages["byte_bpe"].count() > 850


def test_one_document_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages["language_id"].collect()}
    prints = {i: brute_print(t) for i, t in before.items()}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    after = {r.doc_id: r.text for r in stages["simhash"].collect()}
    assert set(after) == set(union_find(pairs, ids).values())
    assert all(before[i] == t for i, t in after.items())


def test_contaminated_documents_go(spark, stages):
    items = [" ".join(r.text.lower().split()) for r in queries.table(spark, SF, "benchmark").collect()]
    exact = {r.doc_id for r in stages["simhash"].collect() if any(i in " ".join(r.text.lower().split()) for i in items)}
    gone = {r.doc_id for r in stages["simhash"].collect()} - {r.doc_id for r in stages["decontamination"].collect()}
    assert exact and exact <= gone and len(gone - exact) <= 2


def test_secrets_are_masked(stages):
    before = {r.doc_id: r for r in stages["decontamination"].collect()}
    scan = secret_scan.scanner()
    changed = 0
    for r in stages["secret_scan"].collect():
        (spans,) = scan([before[r.doc_id].text])
        assert (r.text != before[r.doc_id].text) == bool(spans) and scan([r.text]) == [[]]
        assert r.n_chars - before[r.doc_id].n_chars == len(r.text) - len(before[r.doc_id].text)
        changed += bool(spans)
    assert changed > 5


def test_tokens_decode_to_the_text(stages):
    rows = stages["byte_bpe"].collect()
    assert all(r.round_trip and r.n_tokens * 4 == len(r.token_ids) for r in rows)


def test_odd_and_empty_tables(spark):
    kept = collections.Counter()
    docs = odd(spark)
    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        kept[name] = docs.count()
        none = function(spark, empty(spark), SF)
        assert none.count() == 0
    # Nulls and letterless texts go, and so do copies; the rest reaches the end.
    assert kept["language_id"] == 5 and kept["simhash"] == kept["byte_bpe"] == 4


def test_all_operators_are_registered():
    names = list(queries.queries())
    assert sorted(n.split("_")[0] for n in names) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
    assert pipeline.ORACLE_SQL is None
