import json
import os
import random
import uuid

import pytest
from pyspark.errors import AnalysisException

from spanseek.operators import catalog
from spanseek.sources import documents, exchange, filetree, stores


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    for name in ["a.py", "__init__.py", ".dot.md", "_priv/p.py", ".hid/h.py", "deep/er/est/x.PY", "deep/LICENSE"]:
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(name.encode())
        os.utime(file, (1000, 1000 + len(name)))
    (root / "link").symlink_to(root, target_is_directory=True)
    (root / "link.py").symlink_to(root / "a.py")
    return root


def test_all_files_are_listed(spark, tree, rows):
    found = [r[0] for r in rows(filetree.list_tree(spark, str(tree)), "rel_path")]
    assert found == sorted(
        [".dot.md", ".hid/h.py", "__init__.py", "_priv/p.py", "a.py", "deep/LICENSE", "deep/er/est/x.PY", "link.py"]
    )


def test_uri_roots_give_the_same_listing(spark, tree, rows):
    columns = ["rel_path", "ext", "size", "mtime"]
    plain = filetree.list_tree(spark, str(tree)).where("rel_path not like 'link%'")
    # PyArrow follows directory links, so the comparison tree has none.
    (tree / "link").unlink()
    uri = filetree.list_tree(spark, f"file://{tree}").where("rel_path not like 'link%'")
    assert rows(uri, *columns) == rows(plain, *columns)
    assert rows(filetree.read_contents(uri), "content") == rows(filetree.read_contents(plain), "content")


def test_suffix_filter_and_contents(spark, tree, rows):
    files = filetree.read_tree(spark, f"{tree}/", [".py", ""])
    found = {os.path.relpath(r.path, tree): (r.mtime, bytes(r.content)) for r in files.collect()}
    assert sorted(found) == [".hid/h.py", "__init__.py", "_priv/p.py", "a.py", "deep/LICENSE", "link.py"]
    assert found["a.py"] == (1004.0, b"a.py")


def test_few_tasks_or_many_list_the_same(spark, tree, rows):
    spark.dataSource.register(filetree.FileTreeSource)
    reader = spark.read.format("filetree")
    one = rows(reader.option("tasks", "1").load(str(tree)))
    assert rows(reader.option("tasks", "1000").load(str(tree))) == one and len(one) == 8


def test_unreadable_file_gives_no_row(spark, tree):
    gone = spark.createDataFrame([(str(tree / "gone.py"), 0.0), (str(tree / "a.py"), 0.0)], "path string, mtime double")
    assert filetree.read_contents(gone).count() == 1


def test_crowded_directories_are_one_subtree(spark, tree, rows, monkeypatch):
    whole = rows(filetree.list_tree(spark, str(tree)))
    monkeypatch.setattr(filetree, "_MAX_SUBDIRECTORIES", 1)
    reader = filetree._TreeReader({"path": str(tree), "tasks": "3"})
    parts = reader.partitions()
    assert [p.recursive for p in parts] == [True]
    assert sorted(r for p in parts for r in reader.read(p)) == [tuple(r) for r in whole]


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_each_directory_is_listed_once(spark, tree, rows, monkeypatch, tmp_path, most):
    for i in range(30):
        (tree / "wide" / f"d{i}" / "e").mkdir(parents=True)
        (tree / "wide" / f"d{i}" / "e" / "f.py").write_text("x")
    reader = filetree._TreeReader({"path": str(tree)})
    expected = sorted(r for p in reader.partitions() for r in reader.read(p))
    log, entries = tmp_path / "log", filetree._entries
    log.mkdir()

    def noted(directory):
        with open(log / str(uuid.uuid4()), "w") as file:
            file.write(directory)
        return entries(directory)

    monkeypatch.setattr(filetree, "_entries", noted)
    monkeypatch.setattr(filetree, "_FIRST_DIRECTORIES", most)
    monkeypatch.setattr(filetree, "_DIRECTORIES", most)
    assert rows(filetree.list_tree(spark, str(tree))) == expected and len(expected) == 38
    listed = sorted(p.read_text() for p in log.iterdir())
    assert len(listed) == len(set(listed)) == 6 + 61


def test_hadoop_names_for_s3_are_known():
    system, path = filetree._file_system("s3a://bucket/a/b?region=us-east-1")
    assert type(system).__name__ == "S3FileSystem" and path == "bucket/a/b"


def test_what_cannot_be_read_is_passed_over(tree, monkeypatch):
    scandir = os.scandir

    def guarded(path):
        if str(path).endswith("_priv"):
            raise PermissionError(path)
        return scandir(path)

    monkeypatch.setattr(os, "scandir", guarded)
    for root in (str(tree), f"file://{tree}"):
        reader = filetree._TreeReader({"path": root})
        found = [r for p in reader.partitions() for r in reader.read(p)]
        # Links to directories are not followed, so the walk ends.
        assert len(found) == 7 and all(r[0].startswith(root) for r in found)


def test_root_must_exist(spark, tree):
    with pytest.raises(ValueError):
        filetree.list_tree(spark, str(tree / "nowhere"))


def test_status_of_a_tree(spark, tree):
    status = catalog.tree_status(filetree.list_tree(spark, str(tree)), [".py"]).first()
    assert tuple(status) == (5, 1011.0)


# --- exchange files -------------------------------------------------------------


@pytest.fixture
def save(tmp_path):
    def write(value, name="in.json"):
        path = tmp_path / name
        path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2), encoding="utf-8")
        return str(path)

    return write


SPAN = {"file_path": "a", "first_character_index": 0, "last_character_index": 5}


def test_question_shapes(spark, save):
    read = lambda value: exchange.read_questions(spark, save(value)).orderBy("pos").collect()
    assert [r.question for r in read({"zz": [{"question": "a"}], "aa": [1]})] == ["a"]
    assert read({"n": 3}) == [] and read([]) == [] and read("3") == []
    one, two = read([{"question": "é?", "extra": {"x": [1]}}, {"question": "b", "question_id": "7", "difficulty": "hard", "is_valid": False}])
    assert (one.pos, one.difficulty, one.is_valid) == (0, None, True) and len(one.question_id) == 64
    assert tuple(two) == (1, "7", "b", "hard", False)


@pytest.mark.parametrize("value", [[{"question_id": "1"}], [3], "[{"])
def test_bad_questions_fail(spark, save, value):
    with pytest.raises(Exception):
        exchange.read_questions(spark, save(value)).collect()


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        exchange.read_questions(spark, str(tmp_path / "none.json"))


def test_truth_needs_sources_and_answer(spark, save):
    items = [
        {"question_id": "1", "question": "a", "sources": [SPAN], "answer": "x"},
        {"question_id": "2", "question": "b", "sources": [SPAN]},
        {"question_id": "3", "question": "c", "sources": [{"file_path": "a"}], "answer": "x"},
        {"question_id": "4", "question": "d"},
        {"question_id": "5", "question": "e", "sources": "none", "answer": "x"},
    ]
    for value in (items, {"rag_questions": items}):
        rows = exchange.read_ground_truth(spark, save(value)).orderBy("pos").collect()
        assert [len(r.sources) for r in rows] == [1, 0, 0, 0, 0]
        assert rows[0].answer == "x" and rows[1].answer is None
    with pytest.raises(Exception):
        exchange.read_ground_truth(spark, save({"questions": items})).collect()


def test_results_object(spark, save):
    items = [
        {"question_id": "1", "question": "a", "question_str": "b", "retrieved_sources": [SPAN, SPAN], "answer": "no"},
        {"question_id": "2", "question_str": "c", "retrieved_sources": []},
    ]
    one, two = exchange.read_results(spark, save({"search_results": items, "k": 4})).orderBy("pos").collect()
    assert (one.question_str, len(one.retrieved_sources), one.k) == ("a", 2, 4)
    assert (two.question_str, two.retrieved_sources) == ("c", [])
    for bad in ({"search_results": items}, {"k": 1}, {"search_results": [{"question_id": "1"}], "k": 1}):
        with pytest.raises(Exception):
            exchange.read_results(spark, save(bad)).collect()


def results_of(spark, count=3):
    return spark.createDataFrame(
        [(i, f"q{i}", f'say "{i}"', [("raw/a", 0, 5), ("b", i, 9)]) for i in range(count)],
        "pos long, question_id string, question_str string, retrieved_sources "
        "array<struct<file_path:string,first_character_index:int,last_character_index:int>>",
    )


def test_prefix(spark):
    found = exchange.normalize_paths(results_of(spark, 1), "raw/").first().retrieved_sources
    assert [s.file_path for s in found] == ["raw/a", "raw/b"]


def test_lines_roundtrip(spark, tmp_path, rows):
    target = exchange.write_results(results_of(spark), str(tmp_path), "set.json", 10, "raw/")
    assert target.endswith("/set.json")
    back = exchange.read_result_lines(spark, target)
    expected = exchange.normalize_paths(results_of(spark), "raw/")
    assert rows(back.drop("k")) == rows(expected) and {r.k for r in back.collect()} == {10}


@pytest.mark.parametrize("count", [0, 1, 40])
def test_object_parts_join_to_one_object(spark, tmp_path, save, rows, count):
    target = exchange.write_results(results_of(spark, count), str(tmp_path), "set.json", 7, layout="object")
    parts = sorted(p for p in os.listdir(target) if p.startswith("part-"))
    whole = "".join((tmp_path / "set.json" / p).read_text() for p in parts)
    value = json.loads(whole)
    assert value["k"] == 7 and [r["question_id"] for r in value["search_results"]] == [f"q{i}" for i in range(count)]
    back = exchange.read_results(spark, save(whole, "whole.json"))
    assert rows(back.drop("k")) == rows(results_of(spark, count))


def test_object_folder_is_read_part_by_part(spark, tmp_path, rows):
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(adaptive, "false")
    try:
        target = exchange.write_results(results_of(spark, 200), str(tmp_path), "set.json", 7, layout="object")
    finally:
        spark.conf.unset(adaptive)
    assert len([p for p in os.listdir(target) if p.startswith("part-")]) > 1
    back = exchange.read_results(spark, target)
    assert rows(back.drop("pos", "k")) == rows(results_of(spark, 200).drop("pos"))
    assert back.select("pos").distinct().count() == 200 and back.where("k != 7").count() == 0


@pytest.mark.parametrize("count", [0, 1, 40])
def test_results_in_one_file(spark, tmp_path, rows, count):
    (tmp_path / "set.json").mkdir()  # replaced
    target = exchange.write_results(results_of(spark, count), str(tmp_path), "set.json", 7, layout="file")
    with open(target, encoding="utf-8") as file:
        value = json.load(file)
    assert value["k"] == 7 and [r["question_str"] for r in value["search_results"]] == [f'say "{i}"' for i in range(count)]
    assert rows(exchange.read_results(spark, target).drop("k")) == rows(results_of(spark, count))
    assert [n for n in os.listdir(tmp_path) if not n.startswith(".")] == ["set.json"]


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def nasty(rng):
    """JSON values whose strings hold brackets, commas, quotes and backslashes."""
    text = lambda: "".join(rng.choices('ab,[]{}:"\\ \n\té🙂', k=rng.randrange(14)))
    return {text(): rng.choice([text(), 5, None, [text(), [1, text()]], {text(): [text()]}]) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("seed", range(2))
def test_blocks_of_a_document_are_joined(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    items = [nasty(rng) for _ in range(rng.choice([0, 1, 25]))]
    before, after = {"x,": [nasty(rng), "]"], "k": 3}, {"y": {"z": [1, 2]}, "n": "a,b", "last": 12}
    shapes = [(items, ""), ({"items": items}, "items"), (before | {"items": items} | after, "items")]
    for i, (value, key) in enumerate(shapes):
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(value, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) + rng.choice(["", "\n"]), encoding="utf-8")
        document = documents.read_document(spark, str(path))
        found = document.items(key).orderBy("pos").collect()
        assert [r.pos for r in found] == list(range(len(items))) and [json.loads(r.raw) for r in found] == items
    assert list(document.members) == ["x,", "k", "items", "y", "n", "last"]
    assert (document.scalar("k"), document.scalar("last"), document.items("y"), document.scalar("x,")) == ("3", "12", None, None)


def test_a_document_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "one-line.json"
    path.write_text(json.dumps([{"question": f"number {i}, or {{"} for i in range(60)]), encoding="utf-8")
    assert documents._scanned(spark, str(path)).rdd.getNumPartitions() > 5
    assert [r.question for r in exchange.read_questions(spark, str(path)).orderBy("pos").collect()] == [f"number {i}, or {{" for i in range(60)]


@pytest.mark.parametrize("text", ['[{"question": "a"}', '[{"question": "a}]', '{"a": [1}', '[{"question": "a"}] x', '[1], [2]', '{"a": 1}, {', '[{"question": "a"},]'])
def test_broken_documents_fail(spark, save, text):
    with pytest.raises(Exception):
        exchange.read_questions(spark, save(text)).collect()


@pytest.mark.parametrize("last", [5, 5.0, "5", " 5.0", "5e0"])
def test_indexes_may_be_any_integral_number(spark, save, last):
    span = {"file_path": "a", "first_character_index": "0", "last_character_index": last}
    item = {"question_id": "1", "question": "a", "sources": [span], "answer": "x"}
    (row,) = exchange.read_ground_truth(spark, save([item])).collect()
    assert tuple(row.sources[0]) == ("a", 0, 5)
    found = {"search_results": [{"question_id": "1", "retrieved_sources": [span]}], "k": 1}
    assert tuple(exchange.read_results(spark, save(found)).first().retrieved_sources[0]) == ("a", 0, 5)


@pytest.mark.parametrize("last", [5.5, "x", None, 2**40])
def test_other_indexes_do_not_count(spark, save, last):
    span = {"file_path": "a", "first_character_index": 0, "last_character_index": last}
    (row,) = exchange.read_ground_truth(spark, save([{"question": "a", "sources": [span], "answer": "x"}])).collect()
    assert row.sources == []
    with pytest.raises(Exception):
        exchange.read_results(spark, save({"search_results": [{"question_id": "1", "retrieved_sources": [span]}], "k": 1})).collect()


def test_null_is_not_a_default(spark, save):
    with pytest.raises(Exception):
        exchange.read_questions(spark, save([{"question_id": None, "question": "a"}])).collect()
    (row,) = exchange.read_questions(spark, save([{"question": "a", "is_valid": None}])).collect()
    assert row.is_valid is None and len(row.question_id) == 64


def test_lines_of_questions_and_truth(spark, save):
    lines = [{"question": "a"}, {"question": "b", "question_id": "7", "sources": [SPAN], "answer": "x"}]
    path = save("\n".join(map(json.dumps, lines)) + "\n\n", "lines.json")
    assert [r.question for r in exchange.read_question_lines(spark, path).orderBy("pos").collect()] == ["a", "b"]
    assert [len(r.sources) for r in exchange.read_ground_truth_lines(spark, path).orderBy("pos").collect()] == [0, 1]
    with pytest.raises(Exception):
        exchange.read_question_lines(spark, save('{"question": "a"}\n{"x": 1}', "bad.json")).collect()


# --- state ------------------------------------------------------------------------


def test_freshness(spark, tmp_path):
    path = str(tmp_path / "state")
    assert not stores.index_is_fresh(spark, path, 500, [".py"], "root", 5.0)
    stores.write_state(spark, path, 500, [".md", ".py"], "root", 5.0)
    fresh = lambda size=500, exts=(".py", ".md"), root="root", newest=5.0: stores.index_is_fresh(
        spark, path, size, list(exts), root, newest
    )
    assert fresh() and fresh(newest=5.0005)
    assert not fresh(newest=6.0) and not fresh(size=600) and not fresh(exts=(".py",))
    assert not fresh(size=600, root="other")
    with pytest.raises(ValueError):
        fresh(root="other")


def test_broken_state_is_an_error(spark, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "part-0.json").write_text("{not json")
    with pytest.raises(ValueError):
        stores.index_is_fresh(spark, str(tmp_path / "state"), 500, [], "r", 0.0)


def test_vector_store_overwrites(spark, tmp_path):
    frame = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    stores.write_vectors(frame, str(tmp_path / "v"))
    again = stores.write_vectors(frame.where("vec_id = 1"), str(tmp_path / "v"))
    assert [tuple(r) for r in again.vectors.select("vec_id", "cell").collect()] == [(1, 0)]
