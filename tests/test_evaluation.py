import random

import pytest

from spanseek.operators import evaluation as ev

SPANS = "array<struct<file_path:string,first_character_index:int,last_character_index:int>>"


@pytest.fixture
def tables(spark):
    def build(results, truth):
        found = spark.createDataFrame(
            [(i, q, spans) for i, (q, spans) in enumerate(results)],
            f"pos long, question_id string, retrieved_sources {SPANS}",
        )
        items = spark.createDataFrame(
            [(i, q, spans) for i, (q, spans) in enumerate(truth)], f"pos long, question_id string, sources {SPANS}"
        )
        return found, ev.truth_tables(items)

    return build


def brute_recall(results, truth, k, budget=3000):
    """The score of a set of results, from the rules, one result at a time."""
    known = dict(truth)
    scores = []
    for question, spans in results:
        if question not in known:
            continue
        sources = known[question]
        left, kept = budget, []
        for path, first, last in spans[:k]:
            if left <= 0:
                break
            if path in {s[0] for s in sources}:
                take = min(left, abs(last - first))
                kept.append((path, first, last if take == abs(last - first) else first + take))
                left -= take
        found = 0
        for path, first, last in sources:
            covered = sum(max(0, min(last, b) - max(first, a)) for p, a, b in kept if p == path)
            if abs(last - first) > 0 and covered / abs(last - first) >= 0.05:
                found += 1
        scores.append(found / len(sources) if sources else 0.0)
    return sum(scores) / len(scores) if scores else 0.0


def recalls(found, truth):
    return {r.k: r.recall for r in ev.recall_at_k(found, truth).collect()}


def kept(found, truth):
    ranked = ev.rank_spans(ev.merge_copies(found))
    rows = ev.apply_budget(ev.relevant_spans(ranked, truth)).orderBy("rank").collect()
    return [(r.file_path, r.first_character_index, r.last_character_index) for r in rows]


def test_last_truth_of_an_id_wins(spark):
    items = spark.createDataFrame(
        [(0, "q", [("a", 0, 1)]), (1, "r", []), (2, "q", [("b", 0, 1)])], f"pos long, question_id string, sources {SPANS}"
    )
    unique = {r.question_id: r.sources for r in ev.dedupe_truth(items).collect()}
    assert [s.file_path for s in unique["q"]] == ["b"] and unique["r"] == []


def test_overflowing_span_is_cut(tables):
    found, truth = tables([("q", [("a", 100, 2100), ("a", 5000, 7000), ("a", 9000, 9100)])], [("q", [("a", 0, 10)])])
    assert kept(found, truth) == [("a", 100, 2100), ("a", 5000, 6000)]


def test_irrelevant_spans_cost_nothing(tables):
    found, truth = tables([("q", [("x", 0, 2000), ("a", 0, 2000)])], [("q", [("a", 0, 10)])])
    assert kept(found, truth) == [("a", 0, 2000)]


def test_hit_share(tables):
    for covered, recall in ((4, 0.0), (5, 1.0)):
        found, truth = tables([("q", [("a", 0, covered)])], [("q", [("a", 0, 100)])])
        assert recalls(found, truth)[1] == recall


def test_overlaps_add_up(tables):
    found, truth = tables([("q", [("a", 0, 3), ("a", 50, 53)])], [("q", [("a", 0, 100)])])
    assert recalls(found, truth) == {1: 0.0, 3: 1.0, 5: 1.0, 10: 1.0}


def test_empty_truth_span_stays_in_the_denominator(tables):
    sources = [("a", 0, 10), ("a", 20, 30), ("a", 40, 40)]
    found, truth = tables([("q", [("a", 0, 100)])], [("q", sources)])
    assert recalls(found, truth)[1] == pytest.approx(2 / 3)


def test_unknown_results_and_unanswered_truth_do_not_count(tables):
    found, truth = tables([("x", [("a", 0, 10)]), ("q", [("a", 0, 10)])], [("q", [("a", 0, 10)]), ("r", [("a", 0, 10)])])
    assert recalls(found, truth)[1] == 1.0


def test_question_without_truth_spans_scores_zero(tables):
    found, truth = tables([("q", [("a", 0, 10)]), ("r", [("a", 0, 10)])], [("q", [("a", 0, 10)]), ("r", [])])
    assert recalls(found, truth)[1] == 0.5


def test_nothing_matched(tables):
    found, truth = tables([("x", [("a", 0, 10)])], [("q", [("a", 0, 10)])])
    assert recalls(found, truth) == {1: 0.0, 3: 0.0, 5: 0.0, 10: 0.0}


def random_case(seed):
    rng = random.Random(seed)

    def span():
        first = rng.randrange(0, 4000, 50)
        return (rng.choice("abc"), first, first + rng.choice([0, 5, 40, 300, 900, 2000]))

    truth = [(f"q{rng.randrange(12)}", [span() for _ in range(rng.randrange(5))]) for _ in range(14)]
    truth = [(q, s + s[:1] if rng.random() < 0.3 else s) for q, s in truth]
    results = [(f"q{rng.randrange(15)}", [span() for _ in range(rng.randrange(13))]) for _ in range(30)]
    return results + results[:10], truth  # a third of the results are copies


@pytest.mark.parametrize("seed", range(6))
def test_recall_matches_brute_force(tables, seed):
    results, truth = random_case(seed)
    found, tables_of = tables(results, truth)
    got = recalls(found, tables_of)
    assert got == pytest.approx({k: brute_recall(results, truth, k) for k in (1, 3, 5, 10)})
    assert got[1] <= got[3] <= got[5] <= got[10]


def test_fill_pass(tables):
    spans = [("x", 0, 1000), ("a", 0, 1500), ("x", 0, 1000), ("y", 0, 900), ("z", 0, 50)]
    found, truth = tables([("q", spans)], [("q", [("a", 0, 10)])])
    rows = ev.fill_context(ev.rank_spans(ev.merge_copies(found)), truth).collect()
    chosen = sorted((r["rank"], r.file_path, r.last_character_index, r.relevant) for r in rows)
    assert chosen == [(1, "x", 1000, False), (2, "a", 1500, True), (4, "y", 500, False)]


def test_fill_pass_never_changes_the_score(tables):
    results, truth = random_case(99)
    found, tables_of = tables(results, truth)
    ranked = ev.rank_spans(ev.merge_copies(found))
    alone = ev.apply_budget(ev.relevant_spans(ranked, tables_of))
    filled = ev.fill_context(ranked, tables_of)
    key = ["result_id", "file_path", "truth_first", "truth_last", "overlap_10"]
    with_fill = {tuple(r[c] for c in key) for r in ev.span_overlap(filled, tables_of).collect()}
    assert with_fill == {tuple(r[c] for c in key) for r in ev.span_overlap(alone, tables_of).collect()}


def test_report_counts_all_items(tables, spark):
    found, truth = tables([("q", [("a", 0, 10)]), ("q", [])], [("q", [("a", 0, 10)])])
    items = spark.createDataFrame([("q",), ("q",), ("r",)], "question_id string")
    rows = ev.evaluation_report(found, items, truth).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(k, 3, 0.5) for k in (1, 3, 5, 10)]
