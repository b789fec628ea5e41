import json
import sys
import uuid

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from spanseek import folding, schemas
from spanseek.constants import GENERATION_OPTIONS
from spanseek.operators import answers, vectors
from spanseek.plans import commands
from spanseek.sources import exchange, stores
from spanseek.staging import stage

# The generator below travels with the job; workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    (root / "pkg").mkdir()
    (root / "pkg" / "__init__.py").write_text("")
    (root / "pkg" / "cache.py").write_text("def cache_block(size):\n    return size\n" * 30)
    (root / "guide.md").write_text("# Ünïcode guide\n\nThe paged attention kernel reads blocks.\n" * 20, newline="\r\n")
    (root / "LICENSE").write_text("Permission is granted. " * 20)
    (root / "skip.txt").write_text("paged attention")
    return str(root)


@pytest.fixture(scope="module")
def path(spark, tree, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    assert commands.index_tree(spark, tree, path, 300) == "built"
    return path


@pytest.fixture(scope="module")
def store(spark, path):
    return commands.open_store(spark, path)


def echo_factory():
    def complete(prompts, **options):
        assert options == GENERATION_OPTIONS
        return [f" Answer: {p.count('Source: ')} sources \nmore" for p in prompts]

    return complete


def test_chunks_cover_the_tree(store, tree):
    files = {r.file_path for r in store.chunks.select("file_path").distinct().collect()}
    assert files == {f"{tree}/pkg/cache.py", f"{tree}/guide.md", f"{tree}/LICENSE"}
    assert store.vectors.vectors.count() == store.chunks.count() == store.index.corpus_stats.first().n_docs


def test_second_build_is_skipped(spark, tree, path):
    assert commands.index_tree(spark, tree, path, 300) == "fresh"
    with pytest.raises(ValueError):
        commands.index_tree(spark, f"{tree}/pkg/..", path, 300)
    with pytest.raises(ValueError):
        commands.index_tree(spark, tree, path, 100)
    with pytest.raises(ValueError):
        commands.index_tree(spark, tree, path, 300, [".exe"])


def test_nothing_to_ingest(spark, tmp_path):
    (tmp_path / "tree").mkdir()
    store = tmp_path / "store"
    assert commands.index_tree(spark, str(tmp_path / "tree"), str(store)) == "empty"
    assert not (store / "state").exists()


def test_empty_or_failing_rebuild_leaves_the_store(spark, tmp_path):
    tree, place = tmp_path / "tree", str(tmp_path / "store")
    tree.mkdir()
    (tree / "a.py").write_text("paged attention block\n" * 30)
    assert commands.index_tree(spark, str(tree), place, 300) == "built"
    before = commands.search(spark, commands.open_store(spark, place), "paged attention").collect()
    (tree / "b.py").write_text("more text\n" * 30)

    def broken():
        raise RuntimeError("no model")

    with pytest.raises(Exception, match="no model"):
        commands.index_tree(spark, str(tree), place, 300, embed_factory=broken)
    assert commands.search(spark, commands.open_store(spark, place), "paged attention").collect() == before
    (tree / "a.py").unlink()
    (tree / "b.py").unlink()
    assert commands.index_tree(spark, str(tree), place, 300) == "empty"
    assert commands.search(spark, commands.open_store(spark, place), "paged attention").collect() == before
    (tree / "c.py").write_text("something else\n" * 30)
    assert commands.index_tree(spark, str(tree), place, 300) == "built"
    stores.remove_old_versions(spark, place)
    found = commands.search(spark, commands.open_store(spark, place), "something").collect()
    assert {r.file_path for r in found} == {f"{tree}/c.py"}
    assert len([p for p in (tmp_path / "store").iterdir() if p.name.startswith("v0")]) <= 3


def versions(place):
    return sorted(p.name for p in place.iterdir() if p.name.startswith("v0"))


def test_the_version_published_last_is_current(spark, tmp_path):
    place = str(tmp_path / "store")
    early, late = stores.new_version(), stores.new_version()
    stores.publish(spark, place, late)
    stores.publish(spark, place, early)
    assert early < late and stores.current_version(spark, place) == early


def test_removed_versions_leave_no_tables(spark, tmp_path):
    place = tmp_path / "store"
    chunks = spark.createDataFrame([("a", 0, 9, "some text here")], schemas.chunk)
    before = len(spark.catalog.listTables())
    for _ in range(3):
        commands.build_store(chunks, str(place))
    abandoned, running = "v" + "1".zfill(20) + "-0000abcd", stores.new_version()
    for name in (abandoned, running):
        (place / name / "chunks").mkdir(parents=True)
    current = stores.current_version(spark, str(place))
    stores.remove_old_versions(spark, str(place))
    assert versions(place) == sorted([current, running]) and len(spark.catalog.listTables()) == before + 1
    with pytest.raises(Exception, match="no model"):
        commands.build_store(chunks, str(place), embed_factory=broken_model)
    assert commands.build_store(chunks.where("false"), str(place)) is None
    assert versions(place) == sorted([current, running]) and len(spark.catalog.listTables()) == before + 1


def broken_model():
    raise RuntimeError("no model")


def test_unquoted_texts_do_not_move(spark):
    docs = spark.range(4000).select(F.concat(F.lit("f"), "id").alias("file_path"), F.repeat(F.lit("x"), 50).alias("text"))
    docs = stage(docs, "docs")
    ranked = spark.range(30).select(
        "id", F.lit(1).alias("rank"), F.concat(F.lit("f"), "id").alias("file_path"), F.lit(0).alias("first_character_index"), F.lit(3).alias("last_character_index")
    ).withColumnRenamed("id", "query_id")
    found = answers.fetch_spans(ranked, docs, max_rows=1)
    assert sorted((r.query_id, r.content) for r in found.collect()) == [(i, "xxx") for i in range(30)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("Join")
    assert "held(" in plan[at:]
    kept = docs.where(folding.membership_filter(ranked, "file_path")(F.col("file_path")))
    assert 30 <= kept.count() <= 150
    physical = found._jdf.queryExecution().sparkPlan().toString()
    assert "ArrowEvalPython" in physical


def test_models_see_distinct_texts_only(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def note(texts):
        for text in texts:
            with open(log / str(uuid.uuid4()), "w") as file:
                file.write(text)

    def embedder():
        def model(texts):
            note(texts)
            return np.array([[len(t), 1.0] for t in texts])

        return model

    def generator():
        def complete(prompts, **options):
            note(prompts)
            return [p[:2] for p in prompts]

        return complete

    texts = ["alpha", "beta", "alpha", "alpha", "beta", "c"] * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)
    embedded = vectors.embed_text(frame, "text", embedder).collect()
    assert sorted((r.id, list(r.embedding)) for r in embedded) == [(i, [len(t), 1.0]) for i, t in enumerate(texts)]
    assert sorted(p.read_text() for p in log.iterdir()) == ["alpha", "beta", "c"]
    answered = answers.generate(frame.withColumnRenamed("text", "prompt"), generator).collect()
    assert sorted((r.id, r.raw_answer) for r in answered) == [(i, t[:2]) for i, t in enumerate(texts)]
    assert len(list(log.iterdir())) == 6


def test_scan_commands(spark, tree):
    report = commands.scan_tree(spark, tree).collect()
    assert [tuple(r)[:2] for r in report] == [(".py", 2), (".md", 1), (".txt", 1), ("no_ext", 1), ("total", 5)]
    found = commands.find_files(spark, tree, "PY").collect()
    assert [r.path.rsplit("/", 1)[-1] for r in found] == ["__init__.py", "cache.py"]


def test_search(spark, store, tree):
    found = commands.search(spark, store, "What does the paged-attention kernel read?", 3).orderBy("rank").collect()
    assert [r["rank"] for r in found] == [1, 2, 3]
    assert {r.file_path for r in found} == {f"{tree}/guide.md"}


def test_batch_search_equals_single_search(spark, store, tmp_path):
    texts = ["paged attention kernel", "cache_block size", "permission granted", "zzz qqq", "config.json"]
    (tmp_path / "q.json").write_text(json.dumps({"questions": [{"question": t} for t in texts]}))
    questions = exchange.read_questions(spark, str(tmp_path / "q.json"))
    results = commands.search_dataset(questions, store, 4).orderBy("pos").collect()
    assert [r.question_str for r in results] == texts
    for result in results:
        single = commands.search(spark, store, result.question_str, 4).orderBy("rank").collect()
        assert [tuple(s) for s in result.retrieved_sources] == [tuple(r)[1:] for r in single]
        assert len(single) == 4


def test_spans_are_character_exact(spark, store, tree):
    docs = spark.createDataFrame([("u", "éé\nabc  \n")], "file_path string, text string")
    ranked = spark.createDataFrame(
        [(1, 1, "u", 1, 5), (1, 2, "gone", 0, 4), (2, 1, "u", 3, 99), (3, 1, "u", 5, 2)],
        "query_id long, rank int, file_path string, first_character_index int, last_character_index int",
    )
    fetched = answers.fetch_spans(ranked, docs)
    assert {(r.query_id, r.content) for r in fetched.collect()} == {(1, "é\nab"), (2, "abc  \n"), (3, "")}
    contexts = {r.query_id: r.context for r in answers.build_context(fetched).collect()}
    assert contexts[1] == "Source: u\nContent: é\nab" and contexts[2] == "Source: u\nContent: abc"


def test_answer_one(spark, store):
    result = commands.answer(spark, store, "paged attention", echo_factory, 2).collect()
    assert len(result) == 1 and result[0].answer == "2 sources" and len(result[0].retrieved_sources) == 2


def test_answer_dataset_and_evaluation(spark, store, tmp_path, tree):
    (tmp_path / "q.json").write_text(json.dumps([{"question_id": "1", "question": "paged attention kernel"}, {"question_id": "2", "question": "zzz"}]))
    questions = exchange.read_questions(spark, str(tmp_path / "q.json"))
    target = exchange.write_results(commands.search_dataset(questions, store, 5), str(tmp_path), "out.json", 5)
    results = exchange.read_result_lines(spark, target)
    answered = commands.answer_dataset(results, echo_factory)
    assert {(r.question_id, r.answer) for r in answered.collect()} == {("1", "5 sources"), ("2", "5 sources")}
    exchange.write_results(answered, str(tmp_path), "answers.json", 5)
    first = results.where("pos = 0").first().retrieved_sources[0].asDict()
    truth = [{"question_id": "1", "question": "x", "sources": [first], "answer": "y"}, {"question_id": "9", "question": "z"}]
    (tmp_path / "truth.json").write_text(json.dumps({"rag_questions": truth}))
    items = exchange.read_ground_truth(spark, str(tmp_path / "truth.json"))
    report = commands.evaluate(exchange.read_result_lines(spark, target), items).orderBy("k").collect()
    assert [tuple(r) for r in report] == [(k, 2, 1.0) for k in (1, 3, 5, 10)]


def test_result_without_readable_span_has_an_empty_context(spark):
    results = spark.createDataFrame(
        [(0, "q", "why?", [])],
        "pos long, question_id string, question_str string, retrieved_sources "
        "array<struct<file_path:string,first_character_index:int,last_character_index:int>>",
    )
    docs = spark.createDataFrame([("u", "t")], "file_path string, text string")
    contexts = answers.build_context(answers.fetch_spans(answers.unpack_results(results), docs))
    prompt = answers.build_prompt(results, contexts).first().prompt
    assert prompt.startswith("Context information is below.\n---------------------\n\n-----")
    assert prompt.endswith("Query: why?\nAnswer: ")


@pytest.mark.parametrize("k", [0, -1, "x", None])
def test_k_refused(k):
    with pytest.raises(ValueError):
        commands.validate_k(k)


def test_k_accepted():
    assert commands.validate_k("3") == 3
