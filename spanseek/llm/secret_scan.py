"""Secrets found by regular expressions behind a trigram inverted index.

From each rule's expression a Boolean query over trigrams is derived: an OR of
alternatives, each an AND of the trigrams that any match of it must contain.
Texts are indexed in blocks inside the tasks: the postings of the trigrams that
rules ask for, as bitmaps over the block's texts. Postings are intersected and
united as the query says and only the texts left are searched. A rule with an
alternative without trigrams searches every text. No text is shuffled.

Null and empty texts have no spans. Spans count code points, end exclusive, and
are in order of start, then of the rules. Overlapping spans of different rules
are all reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rows


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


BASE = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
    ),
    # A run cut short by `+` is dropped for its length, so asking for the length at once finds the same spans.
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = (*BASE, *MORE)

# Alternatives spelled out per expression; a part that would exceed this counts as unknown text.
MAX_ALTERNATIVES = 64
_GAP = "\0"


def _spellings(node) -> set[str]:
    """All texts a parsed expression may match, unknown stretches written as gaps."""
    texts = {""}
    for kind, value in node:
        if kind is sre.LITERAL:
            own = {chr(value).lower()}
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            own = {chr(c).lower() for _, c in value}
        elif kind is sre.SUBPATTERN:
            own = _spellings(value[-1])
        elif kind is sre.BRANCH:
            own = set().union(*(_spellings(branch) for branch in value[1]))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = value
            if (least, most) == (0, 1):
                own = {"", *_spellings(inner)}
            elif least:
                own = {_GAP.join(("", s, "")) for s in _spellings(inner)} if least == 1 else {_GAP}
                if least == most and len(_spellings(inner)) == 1:
                    own = {s * least for s in _spellings(inner)}
            else:
                own = {_GAP}
        elif kind is sre.AT:
            own = {""}
        else:
            own = {_GAP}
        if len(texts) * len(own) > MAX_ALTERNATIVES:
            own = {_GAP}
        texts = {a + b for a in texts for b in own}
    return texts


def trigram_query(pattern: str) -> list[set[str]] | None:
    """An OR of ANDs of lower-case trigrams that every match contains; ``None`` if there is none."""
    alternatives = []
    for text in _spellings(sre_parser.parse(pattern)):
        runs = text.split(_GAP)
        grams = {run[i : i + 3] for run in runs for i in range(len(run) - 2)}
        if not grams or not all(g.isascii() for g in grams):
            return None
        if grams not in alternatives:
            alternatives.append(grams)
    # An alternative that asks for more than another adds nothing to the OR.
    return [a for a in alternatives if not any(b < a for b in alternatives)]


class TrigramIndex:
    """Postings of the wanted trigrams over a block of texts, as bitmaps."""

    def __init__(self, wanted: set[str]) -> None:
        codes = {g: int.from_bytes(g.encode(), "big") for g in wanted}
        self._codes = np.array(sorted(codes.values()), np.uint32)
        self._number = {g: int(np.searchsorted(self._codes, c)) for g, c in codes.items()}
        self._heads = np.zeros(1 << 16, bool)
        self._heads[self._codes >> 8] = True

    def postings(self, texts: list[bytes]) -> np.ndarray:
        """``trigrams x texts``: whether a text contains a trigram, in any case."""
        sizes = np.array([len(t) + 2 for t in texts])
        # 0xFF does not occur in UTF-8, so no trigram spans two texts.
        data = np.frombuffer(b"\xff\xff".join([*texts, b""]), np.uint8)
        starts = np.cumsum(sizes) - sizes
        pairs = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
        at = np.flatnonzero(self._heads[pairs[:-1]])
        codes = pairs[at].astype(np.uint32) << np.uint32(8) | data[at + 2]
        number = np.minimum(np.searchsorted(self._codes, codes), self._codes.size - 1)
        real = self._codes[number] == codes
        found = np.zeros((self._codes.size, len(texts)), bool)
        found[number[real], np.searchsorted(starts, at[real], "right") - 1] = True
        return found

    def matching(self, query: list[set[str]] | None, found: np.ndarray) -> np.ndarray:
        """The numbers of the texts that a query leaves."""
        if query is None:
            return np.arange(found.shape[1])
        left = np.zeros(found.shape[1], bool)
        for grams in query:
            left |= found[[self._number[g] for g in grams]].all(axis=0)
        return np.flatnonzero(left)


SPAN_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
)
rows.ARROW[SPAN_TYPE.simpleString()] = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)


def scanner(rules: tuple[Rule, ...] = RULES):
    """A function from a block of texts to the spans of each, ``(start, rule number, end)``."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    wanted = set().union(*(g for q in queries if q for g in q))
    index = TrigramIndex(wanted) if wanted else None
    compiled = [re.compile(rule.pattern) for rule in rules]

    def run(texts: list) -> list[list[tuple[int, int, int]]]:
        found: list[list] = [[] for _ in texts]
        if index:
            postings = index.postings([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
        for n, (rule, query, search) in enumerate(zip(rules, queries, compiled)):
            for i in index.matching(query, postings).tolist() if query else range(len(texts)):
                for match in search.finditer(texts[i] or ""):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[i].append((match.start(), n, match.end()))
        for spans in found:
            spans.sort()
        return found

    return run


def find(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``spans``, an array of ``(kind, start, end)``."""

    def factory():
        scan = scanner(rules)

        def run(texts: list) -> list:
            spans = scan(texts)
            return [[[{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in own] for own in spans]]

        return run

    return rows.append(docs, text, [T.StructField("spans", SPAN_TYPE)], factory, keep)


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of ``docs`` with every secret in ``text`` replaced by ``mask``; texts that overlap are masked as one."""

    def factory():
        scan = scanner(rules)

        def run(texts: list) -> list:
            out = []
            for value, spans in zip(texts, scan(texts)):
                parts, at = [], 0
                for start, _, end in spans:
                    if start >= at:
                        parts += [value[at:start], mask]
                    at = max(at, end)
                out.append(value if not spans else "".join([*parts, value[at:]]))
            return [out]

        return run

    return rows.append(docs, text, [T.StructField(text, T.StringType())], factory).select(*docs.columns)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
