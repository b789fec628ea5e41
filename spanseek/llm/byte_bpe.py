"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The vocabulary becomes a sentencepiece BPE model as it stands: every token is a
piece, its bytes mapped one to one to printable characters, its score the
negative rank, normalisation off. Merging the best-scored pair first is then
merging the lowest rank first. Texts are cut by the tokenizer's pattern; each
distinct pre-token of a batch is encoded once and its ids are looked up for all
its places. Decoding maps ids to pieces and pieces back to bytes.

Null texts count as empty; an empty text has no ids and decodes to no bytes.
Token ids are packed as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import struct

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import rows

# Pre-tokens remembered per task, and the longest one worth remembering.
MEMORY = 400_000
MEMORY_CHARS = 48
_NORMAL, _UNKNOWN = 1, 2


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


_CHARACTERS = byte_characters()
_TO_CHARACTER = {b: c for b, c in enumerate(_CHARACTERS)}
_TO_BYTE = {ord(c): b for b, c in enumerate(_CHARACTERS)}


def to_piece(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARACTER)


def to_bytes(piece: str) -> bytes:
    return piece.translate(_TO_BYTE).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _message(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _integer(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a sentencepiece model; ids are ranks, the unknown piece comes last."""
    ordered = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0, 1, 2, ...")

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _integer(3, kind)
        return _message(1, body)

    pieces = [piece(to_piece(token), -float(rank), _NORMAL) for rank, token in enumerate(ordered)]
    pieces.append(piece("<unk>", 0.0, _UNKNOWN))
    bpe = 2
    trainer = _integer(3, bpe) + _integer(4, len(pieces))
    # identity: no dummy prefix, white space neither removed nor escaped
    normaliser = _message(1, b"identity") + _integer(3, 0) + _integer(4, 0) + _integer(5, 0)
    return b"".join(pieces) + _message(2, trainer) + _message(3, normaliser)


class Encoder:
    """Ids of texts, packed. ``whole`` holds tokens that merging alone does not reach."""

    def __init__(self, model: bytes, pattern: str, whole: dict[str, int]) -> None:
        import regex

        self._find = regex.compile(pattern).findall
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._whole = whole
        self._known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        pieces = [to_piece(w.encode("utf-8", "replace")) for w in words]
        found = self._model.encode(pieces, num_threads=1)
        whole = self._whole
        return {
            w: struct.pack("<I", whole[p]) if p in whole else struct.pack(f"<{len(ids)}I", *ids)
            for w, p, ids in zip(words, pieces, found)
        }

    def __call__(self, text: str | None) -> bytes:
        words = self._find(text) if text else []
        known = self._known
        missing = {w for w in set(words) if w not in known}
        if missing:
            if len(known) > MEMORY:
                known.clear()
                missing = set(words)
            known.update(self._learn(list(missing)))
        packed = b"".join(map(known.__getitem__, words))
        for w in missing:
            if len(w) > MEMORY_CHARS:
                del known[w]
        return packed


class Decoder:
    """Bytes of packed ids, by mapping pieces back to the bytes they stand for."""

    def __init__(self, model: bytes) -> None:
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = pieces.get_piece_size() - 1
        self._bytes = [to_bytes(p) for p in pieces.id_to_piece(list(range(n)))]

    def __call__(self, packed: bytes | None) -> bytes:
        ids = memoryview(packed or b"").cast("I").tolist()
        return b"".join(map(self._bytes.__getitem__, ids))


class Tokenizer:
    """A vocabulary file ready to encode and decode columns; model and pattern are broadcast."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self.model = serialise(ranks)
        self.pattern = pattern
        tokens = sorted(ranks, key=ranks.__getitem__)
        pieces = [to_piece(t) for t in tokens]
        merged = sentencepiece.SentencePieceProcessor(model_proto=self.model).encode(pieces, num_threads=1)
        self.whole = {p: rank for rank, (p, ids) in enumerate(zip(pieces, merged)) if ids != [rank]}

    def encode(self, df: DataFrame, text: str = "text", into: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
        """Rows of ``df`` with the packed ids of ``text``."""
        shared = df.sparkSession.sparkContext.broadcast((self.model, self.pattern, self.whole))

        def factory():
            encode = Encoder(*shared.value)
            return lambda texts: [[encode(t) for t in texts]]

        return rows.append(df, text, [T.StructField(into, T.BinaryType())], factory, keep)

    def decode(self, df: DataFrame, ids: str = "token_ids", into: str = "decoded", keep: list[str] | None = None) -> DataFrame:
        """Rows of ``df`` with the bytes of packed ``ids``."""
        shared = df.sparkSession.sparkContext.broadcast(self.model)

        def factory():
            decode = Decoder(shared.value)
            return lambda packed: [[decode(p) for p in packed]]

        return rows.append(df, ids, [T.StructField(into, T.BinaryType())], factory, keep)
