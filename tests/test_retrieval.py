import math
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from spanseek.constants import STOP_WORDS
from spanseek.operators import hybrid, lexical, vectors
from spanseek.plans import registry
from spanseek.schemas import SPAN, chunk
from spanseek.sources import stores

WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "zeta", "eta", "theta", "io"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 40))) for _ in range(80)]
    texts += ["the of and", "! ? -", texts[0], texts[0]]
    return [(f"f{i % 7}", i * 10, i * 10 + 9, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def chunks(spark, corpus):
    return spark.createDataFrame(corpus, chunk)


@pytest.fixture(scope="module")
def index(chunks):
    return lexical.build_index(chunks)


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(1, "alpha beta?"), (2, "Gamma gamma the"), (3, "config.json nothing"), (4, "io Zeta eta."), (5, "io zeta")]
    return spark.createDataFrame(rows, "query_id long, question string")


def brute_scores(corpus, terms):
    tokens = [[t for t in text.split() if t.isalpha() and t not in STOP_WORDS] for *_, text in corpus]
    n, average = len(corpus), sum(map(len, tokens)) / len(corpus)
    df = Counter(t for words in tokens for t in set(words))
    scores = {}
    for (path, first, last, _), words in zip(corpus, tokens):
        tf = Counter(words)
        total = sum(
            math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t]
            / (tf[t] + 1.5 * (0.25 + 0.75 * len(words) / average))
            for t in terms if tf[t]
        )
        if total:
            scores[path, first, last] = total
    return scores


def test_scores_match_brute_force(asked, index, corpus):
    terms = {1: ["alpha", "beta"], 2: ["gamma", "gamma", "the"], 4: ["io", "zeta", "eta."], 5: ["io", "zeta"], 3: []}
    found = {}
    for r in lexical.bm25_scores(asked, index).collect():
        found.setdefault(r.query_id, {})[r.file_path, r.first_character_index, r.last_character_index] = r.score
    for query, words in terms.items():
        expected = brute_scores(corpus, words)
        assert found.get(query, {}) == pytest.approx(expected)


def test_repeated_term_counts_twice(spark, index):
    asked = spark.createDataFrame([(1, "beta"), (2, "beta beta")], "query_id long, question string")
    best = lexical.bm25_topk(asked, index, 1).orderBy("query_id").collect()
    assert best[1].score == pytest.approx(2 * best[0].score)


def test_topk_order_and_ties(asked, index, corpus):
    k = 6
    found = lexical.bm25_topk(asked, index, k).where("query_id = 1").orderBy("rank").collect()
    expected = sorted(brute_scores(corpus, ["alpha", "beta"]).items(), key=lambda e: (-round(e[1], 6), e[0]))[:k]
    assert [tuple(r[c] for c in SPAN) for r in found] == [key for key, _ in expected]
    assert [r["rank"] for r in found] == list(range(1, k + 1))


def test_topk_beyond_corpus(asked, index, corpus):
    found = lexical.bm25_topk(asked, index, 10_000)
    assert found.where("query_id = 1").count() == len(brute_scores(corpus, ["alpha", "beta"]))
    assert found.where("query_id = 3").count() == 0


def test_statistics_count_chunks_without_tokens(index, corpus):
    stats = index.corpus_stats.first()
    assert stats.n_docs == len(corpus)
    assert lexical.doc_stats(index).where("dl = 0").count() == 2
    assert index.postings.where("term = ''").count() == len(corpus)


def test_postings_are_counted_before_they_become_rows(spark, corpus, rows):
    twice = spark.createDataFrame([*corpus, *corpus[:9], (None, 0, 9, "io io beta"), (None, 0, 9, "eta beta io"), (None, 0, 9, None)], chunk)
    counted = lexical.count_terms(twice, 3, 2)
    assert "HashAggregate" not in counted._jdf.queryExecution().executedPlan().toString()
    expected = Counter()
    for path, first, last, text in [(c.file_path, *c[1:]) for c in twice.where("content IS NOT NULL").collect()]:
        words = [w for w in text.split() if w.isalpha() and w not in STOP_WORDS]
        expected.update((path, first, last, len(words), w) for w in ["", *words])
    assert rows(counted.drop("block")) == sorted(((*key, n) for key, n in expected.items()), key=repr)


def test_counts_of_a_span_meet_across_slices(monkeypatch):
    terms = [["", "b", "a", "b"], ["", "c", "b", "a"], ["", "b", "b", "b"], ["", "d"], ["", "a"]]
    keys = {"file_path": [None, None, None, "x", "x"], SPAN[1]: [0] * 5, SPAN[2]: [9] * 5, "dl": [3, 3, 3, 1, 1], "block": [4, 4, 4, 1, 1]}
    batch = pa.RecordBatch.from_pydict({**keys, "terms": terms})
    found = []
    for size in (1, 2, 3, 1000):
        monkeypatch.setattr(lexical, "_SLICE_ROWS", size)
        out = pa.Table.from_batches(lexical._count_slices(iter([batch.slice(0, 2), batch.slice(2, 0), batch.slice(2)])))
        found.append(sorted(((r["file_path"] or "", r["term"], r["tf"], r["block"]) for r in out.to_pylist())))
    own = [("", "", 3, 4), ("", "a", 2, 4), ("", "b", 6, 4), ("", "c", 1, 4)]
    assert all(f == own + [("x", "", 2, 1), ("x", "a", 1, 1), ("x", "d", 1, 1)] for f in found)


def test_buckets_are_written_in_order_without_the_writers_sort(spark, chunks, tmp_path):
    key, held = "spark.sql.maxConcurrentOutputFileWriters", []

    def watched(frame, *columns):
        held.append(list(columns))
        return within(frame, *columns)

    kind = type(chunks)
    within, kind.sortWithinPartitions = kind.sortWithinPartitions, watched
    try:
        path, before = str(tmp_path / "index"), spark.conf.get(key, None)
        lexical.write_index(chunks, path, 2, blocks=4)
    finally:
        kind.sortWithinPartitions = within
    assert ["term", "block"] in held
    assert spark.conf.get(key, None) == before
    files = sorted((tmp_path / "index" / "postings").glob("*.parquet"))
    assert len(files) == 2
    for file in files:
        stored = [(r.term, r.block) for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert stored == sorted(stored)


def test_weights_do_not_depend_on_hot_split(index, monkeypatch, rows):
    whole = rows(lexical.weighted_postings(index))
    monkeypatch.setattr(lexical, "is_small", lambda df: False)
    for share in (1, 20, 10**9):  # no term, some terms, every term broadcast
        monkeypatch.setattr(lexical, "_HOT_SHARE", share)
        again = rows(lexical.weighted_postings(index))
        assert [r[:-1] for r in again] == [r[:-1] for r in whole]
        assert [r[-1] for r in again] == pytest.approx([r[-1] for r in whole])


def test_index_roundtrip_and_overwrite(spark, chunks, asked, index, tmp_path, rows):
    path = str(tmp_path / "index")
    lexical.write_index(chunks.limit(3), path, 2)
    lexical.write_index(chunks, path, 5)
    loaded = lexical.load_index(spark, path)
    assert rows(lexical.bm25_topk(asked, loaded, 5)) == rows(lexical.bm25_topk(asked, index, 5))
    with pytest.raises(AnalysisException):
        lexical.load_index(spark, str(tmp_path / "missing"))


def test_blocks_of_queries_give_the_same_rows(asked, index, rows):
    whole = rows(lexical.bm25_topk(asked, index, 5))
    blocks = lexical.bm25_topk(asked, index, 5, max_block_rows=2)
    assert rows(blocks) == whole
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    # Only ranked rows are shuffled, by query; postings stay in their buckets.
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(query_id") > 1
    assert rows(lexical.bm25_scores(asked, index, 2)) == rows(lexical.bm25_scores(asked, index))


def test_pruned_topk_gives_the_same_rows(spark, chunks, asked, tmp_path):
    index = lexical.write_index(chunks, str(tmp_path / "index"), 2, blocks=4)
    for k in (1, 3, 1000):
        for probes in (1, 2, 50):
            whole = lexical.bm25_topk(asked, index, k, pruned=False).orderBy("query_id", "rank").collect()
            found = lexical.bm25_topk(asked, index, k, 20, pruned=True, probes=probes).orderBy("query_id", "rank").collect()
            assert [(r.query_id, r["rank"], *(r[c] for c in SPAN)) for r in found] == [
                (r.query_id, r["rank"], *(r[c] for c in SPAN)) for r in whole
            ]
            assert [r.score for r in found] == pytest.approx([r.score for r in whole])


def test_bounds_hold_for_every_chunk(spark, chunks, asked, tmp_path):
    index = lexical.write_index(chunks, str(tmp_path / "index"), 3, blocks=3)
    blocks = index.postings.select(*SPAN, "block").distinct()
    assert blocks.count() == chunks.select(*SPAN).distinct().count()  # a chunk is in one block
    for constants in ({}, {"k1": 0.5, "b": 0.0}, {"k1": 3.0, "b": 1.0}):
        own = replace(index, **constants)
        scores = lexical.bm25_scores(asked, own).join(blocks, list(SPAN))
        bounds = lexical.block_bounds(lexical.query_weights(asked, own), own)
        joined = scores.join(bounds, ["query_id", "block"], "left")
        assert joined.where("bound IS NULL OR score > bound + 1e-9").count() == 0


def test_blocks_that_cannot_matter_are_not_scored(spark, tmp_path):
    texts = [(f"f{i}", 0, 9, "common words everywhere " + ("needle common" if i % 50 == 7 else "filler")) for i in range(300)]
    index = lexical.write_index(spark.createDataFrame(texts, chunk), str(tmp_path / "index"), 2, blocks=40)
    asked = spark.createDataFrame([(1, "common needle")], "query_id long, question string")
    weights = lexical.query_weights(asked, index)
    bounds = lexical.block_bounds(weights, index)
    first = bounds.orderBy(F.col("bound").desc()).limit(8)
    best = lexical.bm25_topk(asked, index, 5)
    rest = lexical.open_blocks(bounds, first, best, 5)
    opened = lexical._postings_of(first, index).join(weights, "term").count()
    opened += lexical._postings_of(rest, index).join(weights, "term").count() if rest.count() else 0
    assert rest.count() == 0
    assert opened * 4 < index.postings.join(weights, "term").count()
    plan = lexical._postings_of(first, index)._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan.split("PushedFilters")[1]
    found, whole = (lexical.bm25_topk(asked, index, 5, pruned=p).orderBy("rank").collect() for p in (True, False))
    assert [r.file_path for r in found] == [r.file_path for r in whole]


def test_opening_adds_no_tables(spark, chunks, tmp_path):
    path = str(tmp_path / "it's an index")
    lexical.write_index(chunks, path, 2)
    before = len(spark.catalog.listTables())
    for _ in range(3):
        assert lexical.load_index(spark, path).postings.count() > 0
    assert len(spark.catalog.listTables()) == before


def test_scoring_needs_no_shuffle_by_chunk(asked, index):
    plan = lexical.bm25_topk(asked, index, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(query_id") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "Bucketed: true" in plan


# --- vectors ------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    data = rng.standard_normal((300, 8)).round(1)
    data[100:200] = data[0]  # a third of all rows are copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)


@pytest.fixture(scope="module")
def targets(spark, points):
    data = points[0][[0, 7, 250]] + 0.05
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "query_id long, embedding array<double>")


def brute_nearest(data, targets, k, metric):
    data = data.astype(np.float32).astype(float)
    out = []
    for q, target in enumerate(targets):
        if metric == "l2":
            distance = ((data - target) ** 2).sum(axis=1)
        else:
            distance = 1 - data @ target / np.linalg.norm(data, axis=1) / np.linalg.norm(target)
        distance = distance.round(6)
        order = sorted(range(len(data)), key=lambda i: (distance[i], i))[:k]
        out += [(q, i, distance[i], rank + 1) for rank, i in enumerate(order)]
    return out


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("bound", [10**6, 8])  # one block, a block per query
def test_knn_is_exact(points, targets, metric, bound):
    found = vectors.knn(targets[1], points[1], 20, metric, max_query_numbers=bound)
    got = [tuple(r) for r in found.orderBy("query_id", "rank").collect()]
    expected = brute_nearest(points[0], targets[0], 20, metric)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in expected]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in expected], abs=2e-6)


def test_knn_with_few_rows(points, targets):
    few = points[1].where("vec_id < 2")
    assert vectors.knn(targets[1], few, 5).count() == 6
    assert vectors.knn(targets[1].where("false"), few, 5).count() == 0
    assert vectors.knn(targets[1], few.where("false"), 5).count() == 0


def recall(found, exact):
    expected = {(r.query_id, r.vec_id) for r in exact.collect()}
    return len({(r.query_id, r.vec_id) for r in found.collect()} & expected) / len(expected)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_search(spark, sf):
    exact = registry.queries()["knn_cosine"](spark, f"/root/testdata/{sf}")
    found = registry.queries()["knn_lsh"](spark, f"/root/testdata/{sf}")
    assert found.count() == exact.count() >= 250 and recall(found, exact) >= 0.9


def multiplied(index, queries, share, metric):
    """Share of all pairs of a query and a row that are compared."""
    places = index.places.toPandas()
    sizes = places.groupby("cell")["rows"].sum()
    centres = vectors._centres(index.cells)
    rows = np.array([sizes.get(c, 0) for c in range(len(centres))])
    matrix = vectors._placed(np.array([r.embedding for r in queries.collect()], float), metric)
    _, cells = vectors._probes(matrix, centres, rows, max(vectors.LEAST_ROWS, share * rows.sum()))
    return rows[cells].sum() / len(matrix) / rows.sum()


@pytest.fixture(scope="module")
def many_vectors(spark, tmp_path_factory):
    """Vectors of sf0.1, each with eleven others around it."""
    base = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()], float)
    rng = np.random.default_rng(8)
    data = np.repeat(base, 12, axis=0) + rng.standard_normal((12 * len(base), base.shape[1])) * 0.11
    frame = pa.table({"vec_id": np.arange(len(data)), "embedding": pa.array(list(data.astype(np.float32)))})
    path = str(tmp_path_factory.mktemp("vectors") / "plain")
    spark.createDataFrame(frame).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_recall_with_a_quarter_of_the_rows(spark, many_vectors, tmp_path, metric):
    index = stores.write_vectors(many_vectors, str(tmp_path / "v"), metric)
    asked = many_vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = vectors.knn(asked, many_vectors, 10, metric)
    assert multiplied(index, asked, vectors.PROBED_SHARE, metric) <= 0.25
    assert recall(vectors.knn_lsh(asked, index, 10), exact) >= 0.9
    assert index.vectors.count() == many_vectors.count()


def test_a_probe_opens_the_files_of_its_cells(spark, many_vectors, tmp_path):
    index = stores.write_vectors(many_vectors, str(tmp_path / "v"), "l2", file_bytes=400_000)
    places = index.places.toPandas()
    n_files, n_cells = places["file"].nunique(), places["cell"].nunique()
    assert n_files >= 10 and len(places) <= n_files + n_cells
    opened = []
    watched = replace(index, read=lambda files: opened.extend(files) or index.read(files))
    one = many_vectors.where("vec_id = 77").select(F.col("vec_id").alias("query_id"), "embedding")
    found = vectors.knn_lsh(one, watched, 10, share=0.02)
    assert found.first().vec_id == 77 and found.count() == 10
    matrix = np.array([one.first().embedding], float)
    sizes = places.groupby("cell")["rows"].sum().reindex(range(n_cells), fill_value=0).to_numpy()
    _, cells = vectors._probes(matrix, vectors._centres(index.cells), sizes, vectors.LEAST_ROWS)
    assert set(opened) == set(places[places["cell"].isin(cells)]["file"]) and len(opened) <= len(cells) / n_cells * n_files + len(cells)


def test_copies_of_a_vector_spread_over_files(spark, tmp_path):
    rng = np.random.default_rng(9)
    data = rng.standard_normal((6000, 8))
    data[:4000] = data[0]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    index = stores.write_vectors(frame, str(tmp_path / "v"), "l2", file_bytes=30_000)
    places = index.places.toPandas()
    hot = places[places["cell"] == places.groupby("cell")["rows"].sum().idxmax()]
    assert hot["rows"].sum() >= 4000 and len(hot) > 2 and hot["rows"].max() < 2000
    asked = frame.where("vec_id in (3, 5000)").select(F.col("vec_id").alias("query_id"), "embedding")
    got = [(r.query_id, r.vec_id) for r in vectors.knn_lsh(asked, index, 3).orderBy("query_id", "rank").collect()]
    assert got[:3] == [(3, 0), (3, 1), (3, 2)] and got[3] == (5000, 5000)


def test_cells_of_few_and_no_rows(spark, points, targets, tmp_path):
    for i, frame in enumerate((points[1].where("vec_id < 2"), points[1].where("false"))):
        index = stores.write_vectors(frame, str(tmp_path / str(i)))
        assert vectors.knn_lsh(targets[1], index, 5).count() == 3 * frame.count()
        assert vectors.knn_lsh(targets[1].where("false"), index, 5).count() == 0


@pytest.mark.parametrize("share", [0.01, 0.3, 1.0])
def test_rows_do_not_depend_on_blocks(spark, points, targets, rows, share, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_ROWS", 1)
    index = stores.write_vectors(points[1], str(tmp_path / "v"))
    one = rows(vectors.knn_lsh(targets[1], index, 10, share=share))
    assert one and rows(vectors.knn_lsh(targets[1], index, 10, share=share, max_query_numbers=8)) == one
    if share == 1:
        assert one == rows(vectors.knn(targets[1], points[1], 10))


def test_probed_cells_are_the_nearest():
    rng = np.random.default_rng(3)
    queries, centres, sizes = rng.standard_normal((5, 12)), rng.standard_normal((40, 12)), rng.integers(1, 9, 40)
    owner, cells = vectors._probes(queries, centres, sizes, 30)
    for i, query in enumerate(queries):
        order = np.argsort(((centres - query) ** 2).sum(axis=1))
        expected, held = [], 0
        for cell in order:
            held += sizes[cell]
            if held > 30:
                break
            expected.append(cell)
        assert cells[owner == i].tolist() == expected
    assert len(vectors._probes(queries, centres, np.full(40, 100), 30)[1]) == 5


def test_a_task_gives_out_k_rows_per_query(spark, targets):
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((4000, 8)))]
    many = spark.createDataFrame(data, "vec_id long, embedding array<float>").coalesce(2)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        best = vectors.knn(targets[1], many, 5)
        assert [r.vec_id for r in best.where("query_id = 0").orderBy("rank").collect()] == [
            i for _, i, _, _ in brute_nearest(np.array([v for _, v in data]), targets[0][:1], 5, "l2")
        ]
        plan = best._jdf.queryExecution().executedPlan()
        counted = str(plan.toString())
        assert counted.count("MapInArrow") == 1
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_hash_embedding(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, ""), (3, "x y")], "id int, text string")
    found = {r.id: np.array(r.embedding) for r in vectors.embed_text(df, "text").collect()}
    assert np.linalg.norm(found[1]) == pytest.approx(1)
    assert sorted(found[1][found[1] > 0]) == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert not found[2].any() and not found[3].any() and len(found[2]) == 64


def test_embedding_by_callers_model(spark):
    def factory():
        def model(texts):
            assert len(texts) <= 100
            return np.array([[len(t), 1.0] for t in texts])

        return model

    df = spark.range(250).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
    got = vectors.embed_text(df, "text", factory).select("text", "embedding").collect()
    assert all(r.embedding == [float(len(r.text)), 1.0] for r in got)


def test_scalar_metadata(spark):
    df = spark.sql("select 'a' s, 1 i, 2.5D d, true b, null n, array(1, 2) l, named_struct('x', 1) t, date'2020-01-02' z")
    assert tuple(vectors.scalar_metadata(df).first()) == ("a", 1, 2.5, True, None, "[1,2]", '{"x":1}', "2020-01-02")


def test_batches_are_compared_and_embedded_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    queries, stored = rng.normal(size=(3, 4)), rng.normal(size=(5000, 4))
    batch = pa.RecordBatch.from_pydict({"vec_id": list(range(5000)), "embedding": stored.tolist()})
    seen, distances = [], vectors._distances
    monkeypatch.setattr(vectors, "_distances", lambda q, v, m: seen.append(len(v)) or distances(q, v, m))
    best = vectors._RunningBest(pa.array([0, 1, 2]), queries, ["vec_id"], 10, "l2")
    best.add(batch)
    nearest = distances(queries, stored, "l2").argsort(axis=1, kind="stable")[:, :10]
    assert pa.Table.from_batches(best.batches()).column("vec_id").to_pylist() == nearest.ravel().tolist()
    assert max(seen) <= 1024 and sum(seen) == 5000
    tokens = pa.array([["a", "b"][: i % 3] for i in range(3000)])
    whole = vectors._histogram_slice(tokens)
    assert whole.equals(pa.concat_arrays([vectors._histogram_slice(tokens.slice(at, 1024)) for at in (0, 1024, 2048)]))


# --- hybrid -------------------------------------------------------------------


def hits(spark, rows, score):
    extra = "score double" if score else "distance double"
    return spark.createDataFrame(rows, f"query_id long, file_path string, first_character_index int, last_character_index int, {extra}, rank int")


def test_fusion_bands_and_dedupe(spark):
    lexical_hits = hits(spark, [(1, "a", 0, 9, 2.0, 1), (1, "b", 0, 9, 0.5, 2), (1, "c", 0, 9, 0.3, 3)], True)
    near = hits(spark, [(1, "v", 0, 9, 0.1, 1), (1, "c", 0, 9, 0.2, 2), (1, "a", 0, 9, 0.3, 3)], False)
    fused = hybrid.dedupe(hybrid.fuse(hybrid.hybrid_candidates(lexical_hits, near)))
    order = [r.file_path for r in hybrid.cut(fused, 10).orderBy("rank").collect()]
    assert order == ["a", "b", "v", "c"]
    assert [r.file_path for r in hybrid.cut(fused, 2).orderBy("rank").collect()] == ["a", "b"]


def test_same_file_other_start_is_another_span(spark):
    lexical_hits = hits(spark, [(1, "a", 0, 9, 2.0, 1), (1, "a", 9, 12, 1.0, 2)], True)
    near = hits(spark, [(1, "a", 0, 9, 0.1, 1)], False)
    fused = hybrid.dedupe(hybrid.fuse(hybrid.hybrid_candidates(lexical_hits, near)))
    assert fused.count() == 2


def test_pack_keeps_questions_without_hits(spark):
    questions = spark.createDataFrame([(0, "q0", "x"), (1, "q0", "y")], "pos long, question_id string, question string")
    ranked = spark.createDataFrame([(1, 2, "b", 0, 5), (1, 1, "a", 3, 4)], "query_id long, rank int, file_path string, first_character_index int, last_character_index int")
    packed = hybrid.pack_results(questions, ranked).orderBy("pos").collect()
    assert packed[0].retrieved_sources == [] and packed[0].question_str == "x"
    assert [tuple(s) for s in packed[1].retrieved_sources] == [("a", 3, 4), ("b", 0, 5)]
