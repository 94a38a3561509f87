"""Packing by power-of-two decomposition.

Every document is cut into pieces whose lengths are powers of two: as many of
the largest length as fit, then the binary digits of the rest. Pieces of one
length form one bucket, each piece is a sequence of its own, so no sequence
crosses documents and none needs padding. No shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
# Words kept per Python worker; more words are encoded again, with the same result.
CACHE_WORDS = 400_000
# Texts of these characters are not changed by NFC, so their words can be encoded one by one.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7eÀ-ÿ]*")
# The word pattern and white space of the tokenizer file.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long"
_ENCODERS: dict[int, "WordEncoder"] = {}


def pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of a document of ``n`` ids, longest pieces first."""
    out, at = [], 0
    while n - at >= longest:
        out.append((at, longest))
        at += longest
    size = longest
    while at < n:
        size >>= 1
        if n - at >= size:
            out.append((at, size))
            at += size
    return out


class WordEncoder:
    """Encodes texts with a ``tokenizers`` file, word by word where that is exact.

    White space always ends a word of this kind of tokenizer and each word is
    encoded alone, so a text is the concatenation of its words' ids. Texts with
    other characters or special-token marks go through the tokenizer whole.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        # bytes as the characters that byte-level vocabularies use for them
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: 256 + k for k, b in enumerate(hidden)}

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            found = self.model.tokenize(word.encode().decode("latin-1").translate(self.shown))
            ids = np.array([t.id for t in found], dtype="<u4").tobytes()
            if len(self.words) < CACHE_WORDS:
                self.words[word] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        ids = b"".join(map(self.word, WORDS.findall(chunk.lower())))
        if len(self.chunks) < CACHE_WORDS:
            self.chunks[chunk] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if "<|" in text or not PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        known = self.chunks.get
        return b"".join([ids if (ids := known(c)) is not None else self.chunk(c) for c in text.split()])


def _encoder(definition: str) -> WordEncoder:
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(definition)
    return _ENCODERS[key]


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 2048) -> DataFrame:
    """Pieces of all documents, one row per piece.

    Columns: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. ``length`` is the bucket: a power of two.

    A document is the ids of its text and then id 1. A null or empty text is
    that one id. Every row is a document of its own, also with a null or a
    repeated doc_id; other columns are not read. No documents: no rows. Texts
    are encoded whole, one at a time, and no sequence is padded or shared.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(definition.value)
        end = np.array([END_ID], dtype="<u4").tobytes()
        names = ["doc_id", "start", "length", "ids", "doc_tokens"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                rows += [(doc_id, at, size, ids[4 * at : 4 * (at + size)], n) for at, size in pieces(n, longest)]
                held += len(ids)
                if held > 8_000_000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(encoded, SCHEMA)
        .withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    )
