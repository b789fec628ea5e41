"""The commands of the library, composed from the operators.

Each command reads and writes tables; nothing is carried in memory from one to
the next. A store is a folder of versions, each with ``chunks``, ``index`` and
``vectors``, a table that names the complete ones, and the ``state`` of the
last build. Versions that are no longer current stay for their readers until
``stores.remove_old_versions``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_CHUNK_SIZE, DEFAULT_EXTENSIONS, DEFAULT_K
from ..functions import query_terms
from ..operators import answers, catalog, chunking, evaluation, hybrid, lexical, vectors
from ..schemas import SPAN
from ..sources import filetree, stores
from ..staging import stage

# A question with at most this many different terms prunes the index scan.
_MAX_PRUNING_TERMS = 64


@dataclass(frozen=True)
class Store:
    """An opened store."""

    chunks: DataFrame
    index: lexical.LexicalIndex
    vectors: vectors.CellIndex


def validate_k(value) -> int:
    """``k`` as a positive integer, else ``ValueError``."""
    try:
        k = int(value)
    except (TypeError, ValueError):
        raise ValueError("k must be an integer") from None
    if k <= 0:
        raise ValueError("k must be greater than 0")
    return k


def ingest(
    spark: SparkSession,
    root: str,
    max_chunk_size: int = DEFAULT_CHUNK_SIZE,
    extensions: list[str] = DEFAULT_EXTENSIONS,
) -> DataFrame:
    """Chunks of a file tree. Map-side but for the spreading of paths."""
    files = filetree.read_tree(spark, root, extensions)
    return chunking.chunk_documents(chunking.decode_text(files), max_chunk_size)


def build_store(
    chunks: DataFrame,
    path: str,
    buckets: int | None = None,
    embed_factory: vectors.EmbedFactory | None = None,
) -> Store | None:
    """Write a new version of chunks, index and vectors below ``path``; ``None`` for no chunks.

    The chunk store is written first and read by the other two, so the tree is
    read and cut once. Chunking and embedding are map-only; the index shuffles
    once. The version counts once all three are complete: an empty or failing
    build leaves the store as it was and removes what it wrote.
    """
    version = stores.new_version()
    try:
        store = _write_store(chunks, f"{path}/{version}", buckets, embed_factory)
    except Exception:
        stores.remove_version(chunks.sparkSession, path, version)
        raise
    if store is None:
        stores.remove_version(chunks.sparkSession, path, version)
    else:
        stores.publish(chunks.sparkSession, path, version)
    return store


def _write_store(
    chunks: DataFrame, place: str, buckets: int | None, embed_factory: vectors.EmbedFactory | None
) -> Store | None:
    stored = stores.write_chunks(chunks, f"{place}/chunks")
    if stored.isEmpty():
        return None
    index = lexical.write_index(stored, f"{place}/index", buckets)
    # Training, assigning and storing read the vectors, so a model embeds them once before.
    embedded = stage(vectors.embed_text(stored, "content", embed_factory).select(*SPAN, "embedding"), "embedded")
    found = stores.write_vectors(embedded, f"{place}/vectors")
    return Store(stored, index, found)


def open_store(spark: SparkSession, path: str) -> Store:
    """Open the newest complete version of a store; a missing one is an error."""
    place = f"{path}/{stores.current_version(spark, path)}"
    return Store(
        stores.read_chunks(spark, f"{place}/chunks"),
        lexical.load_index(spark, f"{place}/index"),
        stores.read_vectors(spark, f"{place}/vectors"),
    )


def index_tree(
    spark: SparkSession,
    root: str,
    path: str,
    max_chunk_size: int = DEFAULT_CHUNK_SIZE,
    extensions: list[str] = DEFAULT_EXTENSIONS,
    buckets: int | None = None,
    embed_factory: vectors.EmbedFactory | None = None,
) -> str:
    """Build the store of a tree unless it is up to date.

    Returns ``"fresh"``, ``"empty"`` (nothing to ingest) or ``"built"``.
    """
    catalog.check_extensions(extensions)
    size = chunking.validate_chunk_size(max_chunk_size)
    # Listed once: the state describes the very files that are read.
    listing = stage(filetree.list_tree(spark, root, extensions), "listing")
    newest = catalog.tree_status(listing, extensions).first()["newest_mtime"]
    wanted = (f"{path}/state", size, extensions, root, newest)
    if stores.index_is_fresh(spark, *wanted):
        return "fresh"
    chunks = chunking.chunk_documents(chunking.decode_text(filetree.read_contents(listing)), size)
    if build_store(chunks, path, buckets, embed_factory) is None:
        return "empty"
    stores.write_state(spark, *wanted)
    return "built"


def _one_question(spark: SparkSession, question: str) -> DataFrame:
    return spark.range(1).select(
        F.col("id").alias("pos"), F.sha2(F.lit(question), 256).alias("question_id"), F.lit(question).alias("question")
    )


def _queries(questions: DataFrame) -> DataFrame:
    return questions.select(F.col("pos").alias("query_id"), "question")


def search(
    spark: SparkSession,
    store: Store,
    question: str,
    k: int = DEFAULT_K,
    embed_factory: vectors.EmbedFactory | None = None,
    share: float | None = vectors.PROBED_SHARE,
) -> DataFrame:
    """Ranked spans ``(rank, span)`` for one question.

    The batch search on one row; as the terms are known beforehand, they are
    pushed into the scans of the tables that are sorted by term, and only the
    files with cells near the question are opened. ``share`` is the part of the
    vectors it is compared with; ``None`` compares all.
    """
    asked = _one_question(spark, question)
    terms = asked.select(F.array_distinct(query_terms(F.col("question")))).first()[0]
    index = store.index
    if len(terms) <= _MAX_PRUNING_TERMS:
        wanted = F.col("term").isin(terms)
        postings, stats, limits = (t.where(wanted) for t in (index.postings, index.term_stats, index.limits))
        index = replace(index, postings=postings, term_stats=stats, limits=limits)
    ranked = hybrid.hybrid_topk(_queries(asked), index, store.vectors, validate_k(k), embed_factory, share)
    return ranked.select("rank", *SPAN)


def search_dataset(
    questions: DataFrame,
    store: Store,
    k: int = DEFAULT_K,
    embed_factory: vectors.EmbedFactory | None = None,
    share: float | None = None,
) -> DataFrame:
    """``(pos, question_id, question_str, retrieved_sources)`` for all questions at once.

    Nearest vectors are exact; ``share`` makes them approximate. Many questions
    together look into most cells, so that saves multiplications, not reads.
    """
    ranked = hybrid.hybrid_topk(
        _queries(questions), store.index, store.vectors, validate_k(k), embed_factory, share
    )
    return hybrid.pack_results(questions, ranked)


def quoted_documents(results: DataFrame) -> DataFrame:
    """Documents the results quote, read from their files: only those, and once."""
    paths = results.select(F.explode("retrieved_sources.file_path").alias("path")).distinct()
    return chunking.decode_text(filetree.read_contents(paths.withColumn("mtime", F.lit(0.0))))


def answer_dataset(
    results: DataFrame, generator_factory: answers.GeneratorFactory, docs: DataFrame | None = None
) -> DataFrame:
    """Stored results with ``answer``; texts come from ``docs`` or from the files."""
    texts = quoted_documents(results) if docs is None else docs
    return answers.answer_results(results, texts, generator_factory)


def answer(
    spark: SparkSession,
    store: Store,
    question: str,
    generator_factory: answers.GeneratorFactory,
    k: int = DEFAULT_K,
    docs: DataFrame | None = None,
    embed_factory: vectors.EmbedFactory | None = None,
    share: float | None = vectors.PROBED_SHARE,
) -> DataFrame:
    """One question: retrieve, then answer; a result of one row."""
    ranked = search(spark, store, question, k, embed_factory, share).withColumn("query_id", F.lit(0))
    results = hybrid.pack_results(_one_question(spark, question), ranked)
    return answer_dataset(stage(results, "results"), generator_factory, docs)


def scan_tree(spark: SparkSession, root: str, include_hidden: bool = False) -> DataFrame:
    """Report of the kinds of files below ``root``, hidden ones only if asked for."""
    return report_files(filetree.list_tree(spark, root), include_hidden)


def report_files(files: DataFrame, include_hidden: bool = False) -> DataFrame:
    """``scan_tree`` for listed files."""
    return catalog.extension_report(files if include_hidden else catalog.drop_hidden(files))


def find_files(spark: SparkSession, root: str, extension: str, include_hidden: bool = False) -> DataFrame:
    """Files below ``root`` of one kind, sorted by path."""
    return catalog.find_by_extension(filetree.list_tree(spark, root), extension, include_hidden)


def evaluate(results: DataFrame, truth_items: DataFrame) -> DataFrame:
    """Report ``(k, n_questions, recall)`` for read results and ground truth."""
    return evaluation.evaluation_report(results, truth_items, evaluation.truth_tables(truth_items))
