"""The registered queries: every operator over the given tables, whole.

Each entry builds what it needs, an index included, from the tables; nothing is
shared between entries. Integers are returned as ``bigint`` and fractions
rounded to six decimals, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ALLOWED_EXTENSIONS, DEFAULT_EXTENSIONS, DEFAULT_K
from ..functions import after_last, clean_answer, path_suffix, query_terms, url_suffix
from ..operators import answers, catalog, chunking, evaluation, hybrid, lexical, vectors
from ..schemas import SPAN
from ..sources import exchange, filetree, stores
from ..staging import new_folder, stage
from . import commands, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.IntegralType):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.FractionalType):
            return F.round(F.col(field.name).cast("double"), 6).alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(function(spark, sf_dir))

    _QUERIES[function.__name__.rstrip("_")] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs --------------------------------------------------------------


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_documents(tables.docs(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> lexical.LexicalIndex:
    return lexical.build_index(_chunks(spark, sf_dir))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.questions(spark, sf_dir).select(F.col("pos").alias("query_id"), "question")


def _store(spark: SparkSession, sf_dir: str) -> commands.Store:
    return commands.build_store(_chunks(spark, sf_dir), new_folder(spark, "store"))


def _lexical_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best ten chunks of each question, packed and staged."""
    hits = lexical.bm25_topk(_asked(spark, sf_dir), _index(spark, sf_dir), DEFAULT_K)
    return stage(hybrid.pack_results(tables.questions(spark, sf_dir), hits), "results")


def _as_text(results: DataFrame) -> DataFrame:
    """Span lists as one string each."""
    spans = F.transform(
        "retrieved_sources",
        lambda s: F.concat(s[SPAN[0]], F.lit(":"), s[SPAN[1]].cast("string"), F.lit("-"), s[SPAN[2]].cast("string")),
    )
    return results.withColumn("spans", F.array_join(spans, "|")).drop("retrieved_sources")


# --- catalogue --------------------------------------------------------------------


@_query
def path_suffix_(spark, sf_dir):
    return tables.catalogue(spark, sf_dir).select("path", path_suffix(F.col("path")).alias("suffix"))


@_query
def url_suffix_(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").select("page_id", url_suffix(F.col("url")).alias("suffix"))


@_query
def hidden_filter(spark, sf_dir):
    return catalog.drop_hidden(tables.catalogue(spark, sf_dir)).select("path")


@_query
def extension_counts(spark, sf_dir):
    return catalog.extension_counts(tables.catalogue(spark, sf_dir))


@_query
def extension_report(spark, sf_dir):
    return catalog.extension_report(tables.catalogue(spark, sf_dir))


@_query
def scan_report(spark, sf_dir):
    return commands.report_files(tables.catalogue(spark, sf_dir))


@_query
def freshness(spark, sf_dir):
    files = tables.catalogue(spark, sf_dir)
    kinds = [".py", ".MD"]
    newest = catalog.tree_status(files.withColumn("ext", path_suffix(F.col("path"))), kinds).first()["newest_mtime"]
    place = new_folder(spark, "state")
    cases = {
        "same": (1000, kinds[::-1], newest),
        "hardly newer": (1000, kinds, newest + 0.0005),
        "newer": (1000, kinds, newest + 1),
        "other size": (999, kinds, newest),
        "other kinds": (1000, [".py"], newest),
    }
    before = stores.index_is_fresh(spark, place, 1000, kinds, sf_dir, newest)
    stores.write_state(spark, place, 1000, kinds, sf_dir, newest)
    found = [("none", before)]
    found += [(name, stores.index_is_fresh(spark, place, size, own, sf_dir, at)) for name, (size, own, at) in cases.items()]
    return spark.createDataFrame([(name, fresh, newest) for name, fresh in found], "state string, fresh boolean, newest double")


@_query
def tree_roundtrip(spark, sf_dir):
    root = new_folder(spark, "tree")
    tables.write_files(tables.files(spark, sf_dir), root)
    found = chunking.decode_text(filetree.read_tree(spark, root))
    return found.select(F.substring("file_path", len(root) + 2, 1_000_000).alias("file_path"), "ext", "text")


@_query
def extension_list(spark, sf_dir):
    return catalog.extension_list(tables.catalogue(spark, sf_dir))


@_query
def find_by_extension(spark, sf_dir):
    return catalog.find_by_extension(tables.catalogue(spark, sf_dir), "MD").select("path")


@_query
def find_without_extension(spark, sf_dir):
    return catalog.find_by_extension(tables.catalogue(spark, sf_dir), "no-ext").select("path")


@_query
def tree_status(spark, sf_dir):
    return catalog.tree_status(tables.catalogue(spark, sf_dir), DEFAULT_EXTENSIONS)


@_query
def unknown_extensions(spark, sf_dir):
    allowed = spark.createDataFrame([(e,) for e in ALLOWED_EXTENSIONS], "ext string")
    return catalog.unknown_extensions(tables.catalogue_docs(spark, sf_dir), allowed)


@_query
def ext_filter(spark, sf_dir):
    return chunking.filter_extensions(tables.catalogue_docs(spark, sf_dir))


# --- decoding and chunking ----------------------------------------------------------


@_query
def decode_text(spark, sf_dir):
    return chunking.decode_text(tables.files(spark, sf_dir))


@_query
def chunk_py(spark, sf_dir):
    return chunking.chunk_documents(tables.docs_of_kind(spark, sf_dir, ".py"), 500)


@_query
def chunk_md(spark, sf_dir):
    return chunking.chunk_documents(tables.docs_of_kind(spark, sf_dir, ".md"), 500)


@_query
def chunk_text(spark, sf_dir):
    return chunking.chunk_documents(tables.docs_of_kind(spark, sf_dir, ""), 500)


@_query
def ingest_chunks(spark, sf_dir):
    docs = chunking.filter_extensions(chunking.decode_text(tables.files(spark, sf_dir)))
    return stores.write_chunks(chunking.chunk_documents(docs, 1000), new_folder(spark, "chunks"))


@_query
def last_separator(spark, sf_dir):
    separators = {"line": "\n", "dot": ". ", "double_bar": "| | ", "same_letters": "aa"}
    cuts = [after_last(F.col("text"), s).alias(name) for name, s in separators.items()]
    return tables.table(spark, sf_dir, "documents").select("doc_id", *cuts)


@_query
def blank_chunks(spark, sf_dir):
    gap = F.concat("text", F.lit(" " * 1500), "text")
    docs = tables.docs(spark, sf_dir).select("file_path", gap.alias("text"))
    return chunking.blank_chunks(chunking.chunk_documents(docs, 500, drop_blank=False)).select(*SPAN)


@_query
def chunk_stats(spark, sf_dir):
    return chunking.chunk_stats(_chunks(spark, sf_dir))


# --- lexical retrieval ----------------------------------------------------------------


@_query
def tokenize(spark, sf_dir):
    return lexical.tokenize(_chunks(spark, sf_dir))


@_query
def stopword_filter(spark, sf_dir):
    words = lexical.drop_stopwords(lexical.tokenize(_chunks(spark, sf_dir)))
    return words.groupBy("term").agg(F.count("*").alias("n"))


@_query
def doc_stats(spark, sf_dir):
    return lexical.doc_stats(_index(spark, sf_dir))


@_query
def corpus_stats(spark, sf_dir):
    return _index(spark, sf_dir).corpus_stats.select("n_docs", "total_length", "avgdl")


@_query
def term_stats(spark, sf_dir):
    return _index(spark, sf_dir).term_stats


@_query
def bm25_postings(spark, sf_dir):
    return lexical.weighted_postings(_index(spark, sf_dir))


@_query
def query_terms_(spark, sf_dir):
    asked = _asked(spark, sf_dir).select("query_id", F.explode(query_terms(F.col("question"))).alias("term"))
    return asked.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


@_query
def bm25_scores(spark, sf_dir):
    return lexical.bm25_scores(_asked(spark, sf_dir), _index(spark, sf_dir))


@_query
def bm25_topk(spark, sf_dir):
    return lexical.bm25_topk(_asked(spark, sf_dir), _index(spark, sf_dir), DEFAULT_K)


@_query
def bm25_topk_pruned(spark, sf_dir):
    return lexical.bm25_topk(_asked(spark, sf_dir), _index(spark, sf_dir), DEFAULT_K, pruned=True)


@_query
def index_roundtrip(spark, sf_dir):
    path = new_folder(spark, "index")
    lexical.write_index(_chunks(spark, sf_dir), path)
    return lexical.bm25_topk(_asked(spark, sf_dir), lexical.load_index(spark, path), DEFAULT_K)


# --- vector retrieval -------------------------------------------------------------------


@_query
def hash_embed(spark, sf_dir):
    embedded = vectors.embed_text(_chunks(spark, sf_dir), "content")
    return embedded.select(*SPAN[:2], F.posexplode("embedding").alias("position", "x"))


@_query
def knn_l2(spark, sf_dir):
    asked = vectors.embed_text(_asked(spark, sf_dir), "question").select("query_id", "embedding")
    stored = vectors.embed_text(_chunks(spark, sf_dir), "content").select(*SPAN, "embedding")
    return vectors.knn(asked, stored, DEFAULT_K, "l2", SPAN)


@_query
def knn_cosine(spark, sf_dir):
    stored = tables.table(spark, sf_dir, "embeddings")
    return vectors.knn(tables.vector_queries(spark, sf_dir), stored, DEFAULT_K, "cosine")


@_query
def knn_lsh(spark, sf_dir):
    stored = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = stores.write_vectors(stored, new_folder(spark, "vectors"), "cosine")
    return vectors.knn_lsh(tables.vector_queries(spark, sf_dir), index, DEFAULT_K)


@_query
def scalar_metadata(spark, sf_dir):
    origin = F.struct("lang", "source").alias("origin")
    return vectors.scalar_metadata(tables.table(spark, sf_dir, "documents").select("doc_id", "n_chars", origin))


# --- hybrid ranking -----------------------------------------------------------------------


@_query
def hybrid_candidates(spark, sf_dir):
    store, asked = _store(spark, sf_dir), _asked(spark, sf_dir)
    hits = lexical.bm25_topk(asked, store.index, DEFAULT_K)
    embedded = vectors.embed_text(asked, "question").select("query_id", "embedding")
    return hybrid.hybrid_candidates(hits, vectors.knn(embedded, store.vectors.vectors, DEFAULT_K, "l2", SPAN))


@_query
def hybrid_topk(spark, sf_dir):
    store = _store(spark, sf_dir)
    return hybrid.hybrid_topk(_asked(spark, sf_dir), store.index, store.vectors, DEFAULT_K, share=None)


def _longest_question(spark: SparkSession, sf_dir: str) -> str:
    longest = F.max_by("question", F.struct(F.length("question"), "query_id"))
    return _asked(spark, sf_dir).agg(longest).first()[0]


@_query
def search_one(spark, sf_dir):
    return commands.search(spark, _store(spark, sf_dir), _longest_question(spark, sf_dir))


@_query
def search_dataset(spark, sf_dir):
    results = commands.search_dataset(tables.questions(spark, sf_dir), _store(spark, sf_dir))
    return _as_text(results)


@_query
def pack_results(spark, sf_dir):
    return _as_text(_lexical_results(spark, sf_dir))


@_query
def results_roundtrip(spark, sf_dir):
    found = _lexical_results(spark, sf_dir)
    target = exchange.write_results(found, new_folder(spark, "export"), "questions.json", DEFAULT_K)
    return _as_text(exchange.read_result_lines(spark, target))


@_query
def results_object_roundtrip(spark, sf_dir):
    found = _lexical_results(spark, sf_dir)
    target = exchange.write_results(found, new_folder(spark, "export"), "questions.json", DEFAULT_K, layout="object")
    return _as_text(exchange.read_results(spark, target)).drop("pos")


@_query
def results_document_roundtrip(spark, sf_dir):
    found = _lexical_results(spark, sf_dir)
    target = exchange.write_results(found, new_folder(spark, "export"), "questions.json", DEFAULT_K, layout="file")
    return _as_text(exchange.read_results(spark, target))


def _as_document(items: DataFrame, order: str, key: str | None) -> str:
    """One JSON file of ``items``: a list, or an object that holds it under ``key``."""
    spark = items.sparkSession
    fields = F.struct(*[c for c in items.columns if c != order])
    first = items.agg(F.min(order)).scalar()
    line = F.concat(F.when(F.col(order) > first, ",").otherwise(""), F.to_json(fields))
    head, tail = ("[", "]") if key is None else (f'{{"{key}": [', "]}")
    frame = spark.createDataFrame([(0, 0, head), (2, 0, tail)], "section int, at long, value string")
    lines = items.select(F.lit(1).alias("section"), F.col(order).cast("long").alias("at"), line.alias("value"))
    parts, target = new_folder(spark, "parts"), new_folder(spark, "document")
    lines.unionByName(frame).orderBy("section", "at").select("value").write.text(parts)
    exchange.join_parts(spark, parts, f"{target}/items.json")
    return f"{target}/items.json"


@_query
def questions_document_roundtrip(spark, sf_dir):
    asked = tables.questions(spark, sf_dir)
    named = F.when(F.col("pos") % 2 == 0, F.col("question_id")).alias("question_id")
    target = _as_document(asked.select("pos", named, "question"), "pos", None)
    return exchange.read_questions(spark, target).drop("pos")


@_query
def questions_roundtrip(spark, sf_dir):
    target = new_folder(spark, "questions")
    asked = tables.questions(spark, sf_dir)
    # Every other question goes without an id.
    named = F.when(F.col("pos") % 2 == 0, F.col("question_id")).alias("question_id")
    asked.select(named, "question").write.json(target)
    return exchange.read_question_lines(spark, target).drop("pos")


@_query
def truth_roundtrip(spark, sf_dir):
    target = new_folder(spark, "truth")
    _truth_items(spark, sf_dir).drop("doc_id").write.json(target)
    return _truth_rows(exchange.read_ground_truth_lines(spark, target))


@_query
def truth_document_roundtrip(spark, sf_dir):
    target = _as_document(_truth_items(spark, sf_dir), "doc_id", "rag_questions")
    return _truth_rows(exchange.read_ground_truth(spark, target))


def _truth_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.struct(
        "file_path",
        F.lit("0").alias(SPAN[1]),
        F.length("text").cast("double").alias(SPAN[2]),
    )
    answer = F.when(F.col("doc_id") % 3 > 0, F.lit("yes")).alias("answer")
    question = F.concat(F.lit("question "), F.col("doc_id").cast("string")).alias("question")
    docs = tables.docs(spark, sf_dir)
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("question_id"), question, F.array(span).alias("sources"), answer)


def _truth_rows(read: DataFrame) -> DataFrame:
    return read.select("question_id", "question", "answer", F.explode_outer("sources").alias("s")).select(
        "question_id", "question", "answer", "s.*"
    )


@_query
def normalize_paths(spark, sf_dir):
    found = _lexical_results(spark, sf_dir).select("pos", "retrieved_sources")
    # Some paths start with this prefix and others do not.
    return _as_text(exchange.normalize_paths(found, "src1"))


# --- context, prompt, answers ---------------------------------------------------------------


def stub_generator():
    """A generator that reports the length of its prompt."""

    def complete(prompts: list[str], **options) -> list[str]:
        return [f"  Answer: {len(prompt)} characters\nmore" for prompt in prompts]

    return complete


def _fetched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    results = _lexical_results(spark, sf_dir)
    return results, answers.fetch_spans(answers.unpack_results(results), tables.docs(spark, sf_dir))


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, fetched = _fetched(spark, sf_dir)
    return answers.build_prompt(results, answers.build_context(fetched)).select("pos", "prompt")


@_query
def fetch_spans(spark, sf_dir):
    return _fetched(spark, sf_dir)[1]


@_query
def build_context(spark, sf_dir):
    return answers.build_context(_fetched(spark, sf_dir)[1])


@_query
def build_prompt(spark, sf_dir):
    return _prompts(spark, sf_dir)


@_query
def generate_stub(spark, sf_dir):
    return answers.generate(_prompts(spark, sf_dir), stub_generator)


@_query
def answer_dataset(spark, sf_dir):
    results = _lexical_results(spark, sf_dir)
    return _as_text(commands.answer_dataset(results, stub_generator, tables.docs(spark, sf_dir)))


@_query
def answer_one(spark, sf_dir):
    question, docs = _longest_question(spark, sf_dir), tables.docs(spark, sf_dir)
    return _as_text(commands.answer(spark, _store(spark, sf_dir), question, stub_generator, docs=docs))


@_query
def clean_answer_(spark, sf_dir):
    raw = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("Answer: "), "text")).otherwise(F.col("text"))
    said = tables.table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return said.select("conv_id", "turn", clean_answer(raw).alias("answer"))


# --- evaluation -------------------------------------------------------------------------------


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.rank_spans(evaluation.merge_copies(_lexical_results(spark, sf_dir)))


def _kept(spark: SparkSession, sf_dir: str, truth: evaluation.Truth) -> DataFrame:
    return evaluation.apply_budget(evaluation.relevant_spans(_ranked(spark, sf_dir), truth))


@_query
def dedupe_truth(spark, sf_dir):
    raw = tables.source_truth(spark, sf_dir)
    lengths = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "n_chars")
    return evaluation.dedupe_truth(raw).join(lengths, "pos").select("question_id", "pos", "n_chars")


@_query
def match_truth(spark, sf_dir):
    truth = evaluation.truth_tables(tables.source_truth(spark, sf_dir))
    return evaluation.match_truth(tables.source_results(spark, sf_dir), truth)


@_query
def relevant_spans(spark, sf_dir):
    found = evaluation.relevant_spans(_ranked(spark, sf_dir), tables.truth(spark, sf_dir))
    return found.select("result_id", "rank", *SPAN)


@_query
def context_budget(spark, sf_dir):
    return _kept(spark, sf_dir, tables.truth(spark, sf_dir)).select("result_id", "rank", *SPAN, "prior")


@_query
def context_fill(spark, sf_dir):
    filled = evaluation.fill_context(_ranked(spark, sf_dir), tables.truth(spark, sf_dir))
    return filled.select("result_id", "rank", *SPAN, "prior", "relevant")


@_query
def span_overlap(spark, sf_dir):
    truth = tables.truth(spark, sf_dir)
    return evaluation.span_overlap(_kept(spark, sf_dir, truth), truth).drop("question_id")


@_query
def question_recall(spark, sf_dir):
    return evaluation.question_recall(_lexical_results(spark, sf_dir), tables.truth(spark, sf_dir))


@_query
def recall_at_k(spark, sf_dir):
    return evaluation.recall_at_k(_lexical_results(spark, sf_dir), tables.truth(spark, sf_dir))


@_query
def evaluate_report(spark, sf_dir):
    asked = tables.questions(spark, sf_dir)
    return evaluation.evaluation_report(_lexical_results(spark, sf_dir), asked, tables.truth(spark, sf_dir))
