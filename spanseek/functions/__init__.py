"""Column expressions: everything here stays inside the JVM."""

from .numbers import two_decimals
from .text import (
    after_last,
    clean_answer,
    clean_query,
    corpus_tokens,
    is_blank,
    normalise_newlines,
    path_suffix,
    query_terms,
    strip,
    url_suffix,
)

__all__ = [
    "after_last",
    "clean_answer",
    "clean_query",
    "corpus_tokens",
    "is_blank",
    "normalise_newlines",
    "path_suffix",
    "query_terms",
    "strip",
    "two_decimals",
    "url_suffix",
]
