"""The registered queries as plain SQL, written from the rules, not from the jobs.

Named subqueries are put together by ``_sql``: it adds those a statement
mentions, in order of dependency.
"""

from __future__ import annotations

import re

from ..constants import (
    ALLOWED_EXTENSIONS,
    BM25_B,
    BM25_K1,
    CONTEXT_BUDGET,
    DEFAULT_EXTENSIONS,
    HASH_DIMENSIONS,
    HIT_SHARE,
    PROMPT_HEAD,
    PROMPT_MIDDLE,
    PROMPT_TAIL,
    RECALL_DEPTHS,
    STOP_WORDS,
    VECTOR_SCORE,
)
from ..functions.numbers import SPLIT
from .tables import CATALOGUE_PATH, EXT_OF_DOC, MIXED_TEXT, structured


def _text(value: str) -> str:
    """A string literal; line breaks written with chr(10)."""
    quoted = value.replace("'", "''").replace("\n", "' || chr(10) || '")
    return f"('{quoted}')"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _suffix(path: str) -> str:
    return rf"regexp_extract(regexp_extract({path}, '[^/]*$'), '(?s)^.+(\.[^.]+)$', 1)"


def _after(separator: str, text: str = "w") -> str:
    """Length up to and with the last separator, NULL without one."""
    return f"nullif(length(regexp_extract({text}, '(?s)^.*{separator}')), 0)"


def _first_of(*separators: str) -> str:
    return "coalesce(" + ", ".join(_after(s) for s in separators) + ", NULL)"


def _walk(source: str, size: int, keep_blank: bool = False) -> str:
    """Chunks of ``source(file_path, ext, text)``; one recursion step per chunk."""
    strong = (
        f"CASE ext WHEN '.py' THEN {_first_of(chr(92) + 'ndef ', chr(92) + 'nclass ')} "
        f"WHEN '.md' THEN {_first_of(chr(92) + 'n#')} ELSE {_first_of(chr(92) + 'n' + chr(92) + 'n')} END"
    )
    weak = (
        f"CASE WHEN ext IN ('.py', '.md') THEN {_first_of(chr(92) + 'n' + chr(92) + 'n', chr(92) + 'n')} "
        f"ELSE {_first_of(chr(92) + 'n', '; ', chr(92) + '. ')} END"
    )
    step = f"""
      SELECT file_path, ext, text, n, a,
        CASE WHEN a + {size} >= n THEN n
             WHEN strong IS NOT NULL THEN a + CASE WHEN strong * 10 > {size} * 8 THEN strong ELSE {size} END
             ELSE a + CASE WHEN weak * 10 > {size} * 9 THEN weak ELSE {size} END END AS b
      FROM (SELECT *, {strong} AS strong, {weak} AS weak
            FROM (SELECT *, substr(text, a + 1, {size}) AS w FROM (%s)))"""
    start = f"SELECT file_path, ext, text, length(text) AS n, 0 AS a FROM {source} WHERE length(text) > 0"
    blank = "" if keep_blank else r"WHERE regexp_matches(content, '\S')"
    return f"""
    (WITH RECURSIVE walk AS ({step % start}
      UNION ALL {step % "SELECT file_path, ext, text, n, b AS a FROM walk WHERE b < n"})
    SELECT * FROM (SELECT file_path, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b,
        substr(text, a + 1, b - a) AS content FROM walk) {blank})"""


_SPAN = "file_path, a AS first_character_index, b AS last_character_index"
_TOKENS = r"regexp_extract_all(lower(%s), '[\p{L}\p{N}_]{2,}')"
_OVERLAPS = ", ".join(
    f"sum(CASE WHEN rank <= {k} THEN greatest(0, least(k.b, t.b) - greatest(k.a, t.a)) ELSE 0 END) AS o{k}"
    for k in RECALL_DEPTHS
)
_HITS = ", ".join(
    f"sum(CASE WHEN t_b > t_a AND o{k} / (t_b - t_a) >= {HIT_SHARE} THEN copies ELSE 0 END) AS h{k}"
    for k in RECALL_DEPTHS
)

_PARTS = {
    "docs": f"""SELECT doc_id, source || '/d' || doc_id || {EXT_OF_DOC} AS file_path,
        {EXT_OF_DOC} AS ext, {MIXED_TEXT} AS text FROM documents""",
    "py_docs": f"SELECT source || '/d' || doc_id || '.py' AS file_path, '.py' AS ext, {structured('text', '.py')} AS text FROM documents",
    "md_docs": f"SELECT source || '/d' || doc_id || '.md' AS file_path, '.md' AS ext, {structured('text', '.md')} AS text FROM documents",
    "text_docs": f"SELECT source || '/d' || doc_id AS file_path, '' AS ext, {structured('text', '')} AS text FROM documents",
    "gap_docs": "SELECT file_path, ext, text || repeat(' ', 1500) || text AS text FROM docs",
    "chunks": _walk("docs", 2000),
    "ingested": _walk("docs", 1000),
    "py_chunks": _walk("py_docs", 500),
    "md_chunks": _walk("md_docs", 500),
    "text_chunks": _walk("text_docs", 500),
    "gap_chunks": _walk("gap_docs", 500, keep_blank=True),
    "catalogue": f"SELECT {CATALOGUE_PATH} AS path, CAST(n_chars AS DOUBLE) AS mtime FROM documents",
    "kinds": f"SELECT path, mtime, {_suffix('path')} AS suffix FROM catalogue",
    "counts": """SELECT CASE WHEN suffix = '' THEN 'no_ext' ELSE lower(suffix) END AS ext,
        count(*) AS n_files FROM kinds GROUP BY 1""",
    "shown_counts": r"""SELECT CASE WHEN suffix = '' THEN 'no_ext' ELSE lower(suffix) END AS ext,
        count(*) AS n_files FROM kinds WHERE NOT regexp_matches(path, '(^|/)\.') GROUP BY 1""",
    "tokens": f"""SELECT file_path, a, b, unnest({_TOKENS % 'content'}) AS term,
        generate_subscripts({_TOKENS % 'content'}, 1) - 1 AS position FROM chunks""",
    "words": f"SELECT file_path, a, b, term FROM tokens WHERE term NOT IN ({_in(STOP_WORDS)})",
    "tf": "SELECT file_path, a, b, term, count(*) AS tf FROM words GROUP BY ALL",
    "lengths": """SELECT file_path, a, b, coalesce(dl, 0) AS dl FROM chunks
        LEFT JOIN (SELECT file_path, a, count(*) AS dl FROM words GROUP BY ALL) USING (file_path, a)""",
    "corpus": "SELECT count(*) AS n_docs, sum(dl) AS total_length, avg(dl) AS avgdl FROM lengths",
    "terms": """SELECT term, df, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) AS idf
        FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus""",
    "postings": f"""SELECT file_path, a, tf.b, term, tf, dl, df,
        idf * tf / (tf + {BM25_K1} * (1 - {BM25_B} + {BM25_B} * dl / avgdl)) AS weight
        FROM tf JOIN lengths USING (file_path, a) JOIN terms USING (term), corpus""",
    "asked": r"""SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id,
        unnest(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_.\s]', ' ', 'g'), '\s+')) AS term
        FROM benchmark) WHERE term <> '' GROUP BY ALL""",
    "scores": """SELECT item_id, file_path, a, b, sum(qtf * weight) AS score
        FROM asked JOIN postings USING (term) GROUP BY ALL""",
    "hits": """SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, file_path, a) AS rank
        FROM scores WHERE score > 0 QUALIFY rank <= 10""",
    "chunk_vectors": "SELECT c.file_path, c.a, c.b, v.vec FROM chunks c JOIN chunk_unit v USING (file_path, a)",
    "chunk_unit": """SELECT file_path, a, list(x ORDER BY dim) AS vec FROM (
        SELECT file_path, a, dim, CAST(coalesce(n / nullif(sqrt(sum(coalesce(n, 0) * coalesce(n, 0))
            OVER (PARTITION BY file_path, a)), 0), 0) AS FLOAT) AS x
        FROM (SELECT file_path, a, dim FROM chunks, dims)
        LEFT JOIN (SELECT file_path, a, bucket AS dim, count(*) AS n
                   FROM (SELECT file_path, a, %s AS bucket FROM tokens) GROUP BY ALL)
        USING (file_path, a, dim)) GROUP BY ALL""",
    "dims": f"SELECT unnest(range({HASH_DIMENSIONS})) AS dim",
    "question_tokens": f"SELECT item_id, unnest({_TOKENS % 'text'}) AS term FROM benchmark",
    "question_unit": """SELECT item_id, list(x ORDER BY dim) AS vec FROM (
        SELECT item_id, dim, CAST(coalesce(n / nullif(sqrt(sum(coalesce(n, 0) * coalesce(n, 0))
            OVER (PARTITION BY item_id)), 0), 0) AS FLOAT) AS x
        FROM (SELECT item_id, dim FROM benchmark, dims)
        LEFT JOIN (SELECT item_id, bucket AS dim, count(*) AS n
                   FROM (SELECT item_id, %s AS bucket FROM question_tokens) GROUP BY ALL)
        USING (item_id, dim)) GROUP BY ALL""",
    "near": """SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY distance, file_path, a) AS rank FROM (
        SELECT item_id, file_path, a, b, round(greatest(0, list_sum(list_transform(list_zip(q.vec, c.vec),
            lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2])))), 6) AS distance
        FROM question_unit q, chunk_vectors c) QUALIFY rank <= 10""",
    "candidates": f"""SELECT item_id, file_path, a, b, score, 0 AS origin, rank AS origin_rank FROM hits UNION ALL
        SELECT item_id, file_path, a, b, {VECTOR_SCORE} AS score, 1 AS origin, rank AS origin_rank FROM near""",
    "hybrid": """SELECT item_id, file_path, a, b,
            row_number() OVER (PARTITION BY item_id ORDER BY place) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id, file_path, a ORDER BY place) AS seen
              FROM (SELECT *, row_number() OVER (PARTITION BY item_id
                    ORDER BY round(score, 6) DESC, origin, origin_rank) AS place FROM candidates))
        WHERE seen = 1 QUALIFY rank <= 10""",
    "packed": """SELECT item_id AS pos, CAST(item_id AS VARCHAR) AS question_id, text AS question_str,
            coalesce(spans, '') AS spans
        FROM benchmark LEFT JOIN (SELECT item_id,
            string_agg(file_path || ':' || a || '-' || b, '|' ORDER BY rank) AS spans FROM %s GROUP BY 1) USING (item_id)""",
    "quotes": """SELECT item_id, file_path, strpos(d.text, q.text) - 1 AS a,
            strpos(d.text, q.text) - 1 + length(q.text) AS b FROM docs d, benchmark q
        WHERE contains(d.text, q.text)""",
    "quote_spans": "SELECT item_id, file_path, a, b, count(*) AS copies FROM quotes GROUP BY ALL",
    "truth_items": """SELECT item_id, coalesce(n, 0) AS n_truth FROM benchmark
        LEFT JOIN (SELECT item_id, count(*) AS n FROM quotes GROUP BY 1) USING (item_id)""",
    "relevant": """SELECT h.* FROM hits h WHERE EXISTS
        (SELECT 1 FROM quotes q WHERE q.item_id = h.item_id AND q.file_path = h.file_path)""",
    "kept": f"""SELECT item_id, rank, file_path, a, CASE WHEN prior + b - a > {CONTEXT_BUDGET}
            THEN a + {CONTEXT_BUDGET} - prior ELSE b END AS b, prior
        FROM (SELECT *, coalesce(sum(b - a) OVER (PARTITION BY item_id ORDER BY rank
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM relevant)
        WHERE prior < {CONTEXT_BUDGET}""",
    "covered": f"""SELECT k.item_id, k.file_path, t.a AS t_a, t.b AS t_b, t.copies, {_OVERLAPS}
        FROM kept k JOIN quote_spans t ON k.item_id = t.item_id AND k.file_path = t.file_path GROUP BY ALL""",
    "recalls": "SELECT item_id, "
    + ", ".join(f"CASE WHEN n_truth > 0 THEN coalesce(h{k}, 0) / n_truth ELSE 0.0 END AS r{k}" for k in RECALL_DEPTHS)
    + f""" FROM (SELECT DISTINCT item_id FROM hits) JOIN truth_items USING (item_id)
        LEFT JOIN (SELECT item_id, {_HITS} FROM covered GROUP BY 1) USING (item_id)""",
    "means": " UNION ALL ".join(f"SELECT {k} AS k, avg(r{k}) AS recall FROM recalls" for k in RECALL_DEPTHS),
    "fetched": """SELECT item_id, rank, file_path, h.a, h.b, substr(text, h.a + 1, h.b - h.a) AS content
        FROM hits h JOIN docs USING (file_path)""",
    "hybrid_fetched": """SELECT item_id, rank, file_path, substr(text, h.a + 1, h.b - h.a) AS content
        FROM hybrid h JOIN docs USING (file_path)""",
    "contexts": r"""SELECT item_id, string_agg('Source: ' || file_path || chr(10) || 'Content: ' ||
            regexp_replace(content, '^\s+|\s+$', '', 'g'), chr(10) || chr(10) ORDER BY rank) AS context
        FROM fetched GROUP BY 1""",
    "prompts": f"""SELECT item_id, text AS question, {_text(PROMPT_HEAD)} || coalesce(context, '') ||
            {_text(PROMPT_MIDDLE)} || text || {_text(PROMPT_TAIL)} AS prompt
        FROM benchmark LEFT JOIN contexts USING (item_id)""",
    "longest": "SELECT arg_max(item_id, (length(text), item_id)) AS item_id FROM benchmark",
    "raw_answers": """SELECT conv_id, turn,
            CASE WHEN turn % 2 = 1 THEN 'Answer: ' || text ELSE text END AS raw
        FROM conversations WHERE role = 'assistant'""",
}
_COSINE = """SELECT query_id, vec_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank
    FROM (SELECT query_id, vec_id, round(greatest(0, 1 - dot / (sqrt(qq) * sqrt(vv))), 6) AS distance
      FROM (SELECT q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE))) AS dot,
        list_sum(list_transform(q.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS qq,
        list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS vv
      FROM embeddings q CROSS JOIN embeddings v WHERE q.vec_id % 20 = 0)) QUALIFY rank <= 10"""
# The same steps on the hybrid ranking.
_PARTS["hybrid_contexts"] = _PARTS["contexts"].replace("FROM fetched", "FROM hybrid_fetched")
_PARTS["hybrid_prompts"] = _PARTS["prompts"].replace("JOIN contexts", "JOIN hybrid_contexts")
_BUCKET = f"CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % {HASH_DIMENSIONS}"
for _name in ("chunk_unit", "question_unit"):
    _PARTS[_name] = _PARTS[_name] % _BUCKET
_PARTS["packed_hits"] = _PARTS["packed"] % "hits"
_PARTS["packed_hybrid"] = _PARTS.pop("packed") % "hybrid"
_REUSED = {"chunks", "tokens", "tf", "lengths", "postings", "hits", "quotes", "near", "hybrid", "chunk_vectors"}


def _two_decimals(value: str) -> str:
    """As printed: by the exact value, exact halves go to the even digit."""
    value = f"({value})"
    low = f"floor({value} * 100)"
    rest = f"({value} * 100 - {low})"
    high = f"({value} * {SPLIT}::DOUBLE - ({value} * {SPLIT}::DOUBLE - {value}))"
    lost = f"(({high} * 100 - {value} * 100) + ({value} - {high}) * 100)"
    half = f"{lost} > 0 OR ({lost} = 0 AND CAST({low} AS BIGINT) % 2 = 1)"
    return f"CAST({low} + CASE WHEN {rest} > 0.5 OR ({rest} = 0.5 AND ({half})) THEN 1 ELSE 0 END AS DOUBLE) / 100"


def _report(counts: str) -> str:
    share = _two_decimals(f"CAST(100.0 AS DOUBLE) * n_files / (SELECT sum(n_files) FROM {counts})")
    return f"""SELECT ext, CAST(n_files AS BIGINT) AS n_files, {share} AS percentage
        FROM (SELECT ext, n_files FROM {counts} UNION ALL SELECT 'total', sum(n_files) FROM {counts})"""


def _sql(statement: str) -> str:
    needed: list[str] = []

    def add(text: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"(\bFROM|\bJOIN|,)\s+{name}\b", text):
                add(_PARTS[name])
                if name not in needed:
                    needed.append(name)

    add(statement)
    if not needed:
        return statement
    parts = [f"{name} AS {'MATERIALIZED ' if name in _REUSED else ''}({_PARTS[name]})" for name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + statement


def _chunk_rows(name: str) -> str:
    return _sql(f"SELECT {_SPAN}, content FROM {name}")


def oracle_sql() -> dict[str, str]:
    recall_columns = ", ".join(f"round(r{k}, 6) AS recall_{k}" for k in RECALL_DEPTHS)
    overlap_columns = ", ".join(f"CAST(o{k} AS BIGINT) AS overlap_{k}" for k in RECALL_DEPTHS)
    topk = _sql(f"SELECT item_id AS query_id, {_SPAN}, round(score, 6) AS score, rank FROM hits")
    questions = _sql(
        """SELECT CASE WHEN item_id % 2 = 0 THEN CAST(item_id AS VARCHAR) ELSE sha256(text) END AS question_id,
            text AS question, CAST(NULL AS VARCHAR) AS difficulty, true AS is_valid FROM benchmark"""
    )
    truth = _sql(
        """SELECT CAST(doc_id AS VARCHAR) AS question_id, 'question ' || doc_id AS question,
            CASE WHEN doc_id % 3 > 0 THEN 'yes' END AS answer,
            CASE WHEN doc_id % 3 > 0 THEN file_path END AS file_path,
            CASE WHEN doc_id % 3 > 0 THEN CAST(0 AS BIGINT) END AS first_character_index,
            CASE WHEN doc_id % 3 > 0 THEN length(text) END AS last_character_index FROM docs"""
    )
    return {
        # catalogue
        "path_suffix": _sql("SELECT path, suffix FROM kinds"),
        "url_suffix": "SELECT page_id, "
        + _suffix("regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)")
        + " AS suffix FROM pages",
        "hidden_filter": _sql(r"SELECT path FROM catalogue WHERE NOT regexp_matches(path, '(^|/)\.')"),
        "extension_counts": _sql("SELECT ext, n_files FROM counts"),
        "extension_report": _sql(_report("counts")),
        "scan_report": _sql(_report("shown_counts")),
        "extension_list": _sql("SELECT DISTINCT lower(suffix) AS ext FROM kinds"),
        "find_by_extension": _sql("SELECT path FROM kinds WHERE lower(suffix) = '.md'"),
        "find_without_extension": _sql(r"SELECT path FROM kinds WHERE suffix = '' AND NOT regexp_matches(path, '(^|/)\.')"),
        "tree_status": _sql(
            f"SELECT count(*) AS n_files, coalesce(max(mtime), 0) AS newest_mtime FROM kinds WHERE suffix IN ({_in(DEFAULT_EXTENSIONS)})"
        ),
        "unknown_extensions": _sql(
            f"SELECT DISTINCT suffix AS ext FROM kinds WHERE suffix NOT IN ({_in(ALLOWED_EXTENSIONS)})"
        ),
        "ext_filter": _sql(f"SELECT path AS file_path, suffix AS ext FROM kinds WHERE suffix IN ({_in(DEFAULT_EXTENSIONS)})"),
        # decoding and chunking
        "decode_text": _sql("SELECT file_path, ext, text FROM docs WHERE length(text) > 0"),
        "chunk_py": _chunk_rows("py_chunks"),
        "chunk_md": _chunk_rows("md_chunks"),
        "chunk_text": _chunk_rows("text_chunks"),
        "ingest_chunks": _chunk_rows("ingested"),
        "last_separator": "SELECT doc_id, "
        + ", ".join(
            f"CAST(coalesce({_after(pattern, 'text')}, 0) AS BIGINT) AS {name}"
            for name, pattern in (("line", r"\n"), ("dot", r"\. "), ("double_bar", r"\| \| "), ("same_letters", "aa"))
        )
        + " FROM documents",
        "blank_chunks": _sql(rf"SELECT {_SPAN} FROM gap_chunks WHERE NOT regexp_matches(content, '\S')"),
        "chunk_stats": _sql(
            """SELECT file_path, count(*) AS n_chunks, CAST(sum(b - a) AS BIGINT) AS n_chars, max(b - a) AS max_chars,
                min(a) AS first_char, max(b) AS last_char FROM chunks GROUP BY file_path"""
        ),
        # lexical retrieval
        "tokenize": _sql(f"SELECT {_SPAN}, position, term FROM tokens"),
        "stopword_filter": _sql("SELECT term, count(*) AS n FROM words GROUP BY term"),
        "doc_stats": _sql(f"SELECT {_SPAN}, dl FROM lengths"),
        "corpus_stats": _sql("SELECT n_docs, CAST(total_length AS BIGINT) AS total_length, round(avgdl, 6) AS avgdl FROM corpus"),
        "term_stats": _sql("SELECT term, df, round(idf, 6) AS idf FROM terms"),
        "bm25_postings": _sql(f"SELECT {_SPAN}, term, tf, dl, df, round(weight, 6) AS weight FROM postings"),
        "query_terms": _sql("SELECT item_id AS query_id, term, qtf FROM asked"),
        "bm25_scores": _sql(f"SELECT item_id AS query_id, {_SPAN}, round(score, 6) AS score FROM scores"),
        "bm25_topk": topk,
        "bm25_topk_pruned": topk,
        "index_roundtrip": topk,
        # vector retrieval
        "hash_embed": _sql(
            """SELECT file_path, a AS first_character_index, unnest(range(64)) AS position,
                round(CAST(unnest(vec) AS DOUBLE), 6) AS x FROM chunk_unit"""
        ),
        "knn_l2": _sql(f"SELECT item_id AS query_id, {_SPAN}, distance, rank FROM near"),
        "knn_cosine": _COSINE,
        # A table of this size is within the rows every query is compared with.
        "knn_lsh": _COSINE,
        "scalar_metadata": "SELECT doc_id, n_chars, CAST(to_json({'lang': lang, 'source': source}) AS VARCHAR) AS origin FROM documents",
        # hybrid ranking
        "hybrid_candidates": _sql(
            f"SELECT item_id AS query_id, {_SPAN}, round(score, 6) AS score, CAST(origin AS BIGINT) AS origin, origin_rank FROM candidates"
        ),
        "hybrid_topk": _sql(f"SELECT item_id AS query_id, rank, {_SPAN} FROM hybrid"),
        "search_one": _sql(
            f"SELECT rank, {_SPAN} FROM hybrid JOIN longest USING (item_id)"
        ),
        "search_dataset": _sql("SELECT pos, question_id, question_str, spans FROM packed_hybrid"),
        "pack_results": _sql("SELECT pos, question_id, question_str, spans FROM packed_hits"),
        "results_roundtrip": _sql("SELECT pos, question_id, question_str, spans, CAST(10 AS BIGINT) AS k FROM packed_hits"),
        "results_object_roundtrip": _sql("SELECT question_id, question_str, spans, CAST(10 AS BIGINT) AS k FROM packed_hits"),
        "results_document_roundtrip": _sql(
            "SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, question_id, question_str, spans, CAST(10 AS BIGINT) AS k FROM packed_hits"
        ),
        "questions_roundtrip": questions,
        "questions_document_roundtrip": questions,
        "truth_roundtrip": truth,
        "truth_document_roundtrip": truth,
        "tree_roundtrip": _sql("SELECT file_path, ext, text FROM docs WHERE length(text) > 0"),
        "freshness": _sql(
            """SELECT state, fresh, (SELECT max(mtime) FROM kinds WHERE suffix IN ('.py', '.MD')) AS newest
            FROM (VALUES ('none', false), ('same', true), ('hardly newer', true), ('newer', false),
                ('other size', false), ('other kinds', false)) AS v(state, fresh)"""
        ),
        "normalize_paths": _sql(
            """SELECT item_id AS pos, coalesce(spans, '') AS spans FROM benchmark LEFT JOIN (
                SELECT item_id, string_agg(CASE WHEN starts_with(file_path, 'src1') THEN file_path
                ELSE 'src1' || file_path END || ':' || a || '-' || b, '|' ORDER BY rank) AS spans FROM hits GROUP BY 1)
                USING (item_id)"""
        ),
        # context, prompt, answers
        "fetch_spans": _sql(f"SELECT item_id AS query_id, rank, {_SPAN}, content FROM fetched"),
        "build_context": _sql("SELECT item_id AS query_id, context FROM contexts"),
        "build_prompt": _sql("SELECT item_id AS pos, prompt FROM prompts"),
        "generate_stub": _sql(
            "SELECT item_id AS pos, '  Answer: ' || length(prompt) || ' characters' || chr(10) || 'more' AS raw_answer FROM prompts"
        ),
        "answer_dataset": _sql(
            """SELECT pos, question_id, question_str, spans, length(prompt) || ' characters' AS answer
            FROM packed_hits JOIN prompts ON pos = item_id"""
        ),
        "answer_one": _sql(
            """SELECT CAST(0 AS BIGINT) AS pos, sha256(question_str) AS question_id, question_str, spans,
                length(prompt) || ' characters' AS answer
            FROM packed_hybrid JOIN longest ON pos = item_id JOIN hybrid_prompts USING (item_id)"""
        ),
        "clean_answer": _sql(
            r"""SELECT conv_id, turn, CASE WHEN length(t) < 3 OR NOT regexp_matches(t, '[\p{L}\p{N}]')
                THEN 'I don''t know' ELSE t END AS answer
            FROM (SELECT conv_id, turn, regexp_replace(replace(string_split(
                regexp_replace(raw, '^\s+|\s+$', '', 'g'), chr(10))[1], 'Answer:', ''), '^\s+|\s+$', '', 'g') AS t
            FROM raw_answers)"""
        ),
        # evaluation
        "dedupe_truth": """SELECT source AS question_id, max(doc_id) AS pos, arg_max(n_chars, doc_id) AS n_chars
            FROM documents JOIN labels USING (doc_id) GROUP BY 1""",
        "match_truth": """SELECT doc_id AS pos, source AS question_id, CAST(1 AS BIGINT) AS n_truth FROM documents
            WHERE source IN (SELECT source FROM documents JOIN labels USING (doc_id))""",
        "relevant_spans": _sql(f"SELECT item_id AS result_id, rank, {_SPAN} FROM relevant"),
        "context_budget": _sql(
            """SELECT item_id AS result_id, rank, file_path, a AS first_character_index,
                CAST(b AS BIGINT) AS last_character_index, CAST(prior AS BIGINT) AS prior FROM kept"""
        ),
        "context_fill": _sql(
            f"""SELECT item_id AS result_id, rank, file_path, a AS first_character_index,
                CAST(CASE WHEN prior + b - a > {CONTEXT_BUDGET} THEN a + {CONTEXT_BUDGET} - prior ELSE b END AS BIGINT)
                  AS last_character_index, CAST(prior AS BIGINT) AS prior, good AS relevant
            FROM (SELECT *, coalesce(sum(b - a) OVER (PARTITION BY item_id ORDER BY good DESC, rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
              FROM (SELECT h.*, EXISTS (SELECT 1 FROM quotes q WHERE q.item_id = h.item_id
                    AND q.file_path = h.file_path) AS good FROM hits h))
            WHERE prior < {CONTEXT_BUDGET}"""
        ),
        "span_overlap": _sql(
            f"SELECT item_id AS result_id, file_path, t_a AS truth_first, t_b AS truth_last, copies, {overlap_columns} FROM covered"
        ),
        "question_recall": _sql(
            f"SELECT item_id AS result_id, CAST(item_id AS VARCHAR) AS question_id, CAST(1 AS BIGINT) AS n_results, {recall_columns} FROM recalls"
        ),
        "recall_at_k": _sql("SELECT CAST(k AS BIGINT) AS k, round(recall, 6) AS recall FROM means"),
        "evaluate_report": _sql(
            "SELECT CAST(k AS BIGINT) AS k, (SELECT count(*) FROM benchmark) AS n_questions, "
            f"{_two_decimals('recall')} AS recall FROM means"
        ),
    }
