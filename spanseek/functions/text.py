"""String rules as Catalyst expressions.

Character classes are spelled out (``\\p{L}\\p{N}_``) because Java's bare
``\\w`` and ``\\s`` know ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    ANSWER_MARK,
    MIN_ANSWER_LENGTH,
    MIN_TOKEN_LENGTH,
    NO_ANSWER,
    STOP_WORDS,
    WORD_CHARS,
)

_SPACE = r"[\s\x1c-\x1f]"


def path_suffix(path: Column) -> Column:
    """Last ``.x`` of the base name; "" for ``Dockerfile``, ``.gitignore``, ``file.``."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)\z", 1)


def url_suffix(url: Column) -> Column:
    """Suffix of the path part of a URL, without host, query and fragment."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    return path_suffix(path)


def normalise_newlines(text: Column) -> Column:
    r"""``\r\n`` and ``\r`` become ``\n`` before any offset is taken."""
    return F.regexp_replace(text, "\r\n?", "\n")


def strip(text: Column) -> Column:
    """Drop white space of any script at both ends."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    """True for white space only (and for empty text)."""
    return ~text.rlike(rf"(?U)[^\s\x1c-\x1f]")


def after_last(text: Column, separator: str) -> Column:
    """Index just after the last occurrence of ``separator``, 0 if there is none."""
    tail = F.substring_index(text, separator, -1)
    return F.when(text.contains(separator), F.length(text) - F.length(tail)).otherwise(0)


def corpus_tokens(text: Column, drop_stop_words: bool = True) -> Column:
    """Lower-cased runs of two or more word characters, with repeats."""
    pattern = f"[{WORD_CHARS}]{{{MIN_TOKEN_LENGTH},}}"
    tokens = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    if not drop_stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(STOP_WORDS))


def clean_query(text: Column) -> Column:
    """Lower case; all but word characters, white space and dots become blanks."""
    return F.regexp_replace(F.lower(text), rf"(?U)[^{WORD_CHARS}.\s\x1c-\x1f]", " ")


def query_terms(text: Column) -> Column:
    """White-space separated terms of the cleaned query, with repeats.

    Stop words and one-letter terms stay: no index holds them, so they score
    nothing. A term with a dot never matches for the same reason.
    """
    parts = F.split(clean_query(text), rf"(?U){_SPACE}+")
    return F.filter(parts, lambda t: t != "")


def clean_answer(raw: Column) -> Column:
    """First line without answer marks; too short or wordless becomes a refusal."""
    first_line = F.split_part(strip(raw), F.lit("\n"), F.lit(1))
    answer = strip(F.replace(first_line, F.lit(ANSWER_MARK), F.lit("")))
    useless = (F.length(answer) < MIN_ANSWER_LENGTH) | ~answer.rlike(r"[\p{L}\p{N}]")
    return F.when(useless, NO_ANSWER).otherwise(answer)
