"""Fill-in-middle transformation with a sparse index of multibyte characters.

A text is cut at token bounds into prefix, middle and suffix, which are put in
another order behind markers. Cuts are needed as bytes (to slice UTF-8) and as
code points (to report spans). Only the characters of several bytes are
recorded, each with its place and the excess bytes up to it; a binary search
there converts either kind of place, and text without such characters needs
plain arithmetic only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers of prefix, suffix and middle, and the parts of a hundred of each decision.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

#: Bytes of text that one step of a task looks at, and rows of one batch that it returns.
SLICE_BYTES, SLICE_ROWS = 8_000_000, 2_000


@dataclass(frozen=True)
class ExceptionIndex:
    """Places of the multibyte characters of a buffer.

    byte: where each begins; excess: bytes beyond one per character, up to and with it.
    """

    byte: np.ndarray
    excess: np.ndarray

    @staticmethod
    def of(data: np.ndarray) -> ExceptionIndex:
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        return ExceptionIndex(at, np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)))

    def _before(self, k: np.ndarray) -> np.ndarray:
        """Excess of the first ``k`` exceptions."""
        return np.where(k > 0, self.excess[np.maximum(k - 1, 0)], 0) if len(self.excess) else np.zeros(len(k), dtype=np.int64)

    def to_chars(self, place: np.ndarray) -> np.ndarray:
        """Code points before byte ``place`` (a character's first byte, or the end)."""
        return place - self._before(np.searchsorted(self.byte, place))

    def to_bytes(self, place: np.ndarray) -> np.ndarray:
        """The byte at which code point ``place`` begins."""
        k = np.searchsorted(self.byte - self._before(np.arange(len(self.byte))), place)
        return place + self._before(k)


def token_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bytes at which tokens begin: runs of A-Z and a-z, and every other character; no token goes over a bound."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    first = bounds[bounds < len(data)]
    starts[first] = (data[first] & 0xC0) != 0x80
    return np.flatnonzero(starts)


def cut_points(texts: list[bytes], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """(tokens, first cut, second cut, code points of prefix, of middle) of every text; cuts are bytes of the text."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    begins = ends - np.array([len(t) for t in texts], dtype=np.int64)
    starts = token_starts(data, begins)
    first = np.searchsorted(starts, begins)
    n = np.searchsorted(starts, ends) - first
    index = ExceptionIndex.of(data)
    stops = np.append(starts, len(data))
    cuts = []
    for unit in (np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))):
        cuts.append(np.where(unit == n, ends, stops[np.minimum(first + unit, len(starts))]))
    chars = [index.to_chars(c) for c in (begins, *cuts)]
    return n, cuts[0] - begins, cuts[1] - begins, chars[1] - chars[0], chars[2] - chars[1]


def decisions(doc_id: Column, salt: str = "1") -> list[Column]:
    """Four numbers below 2**32 that follow from the document's id alone."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _arranged(text: bytes, a: int, b: int, form: str) -> bytes:
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)) if form == "spm" else text


def rebuilt(output: bytes, form: str) -> bytes:
    """The text that ``output`` was made of; its markers are where they first occur, since a marked text holds no others."""
    if form == "plain":
        return output
    head, _, middle = output.partition(MIDDLE)
    if form == "psm":
        prefix, _, suffix = head[len(PREFIX):].partition(SUFFIX)
    else:
        suffix, _, prefix = head[len(SUFFIX):].partition(PREFIX)
    return prefix + middle + suffix


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text (or one row)."""
    low, held = 0, 0
    for k, value in enumerate(batch.column(column)):
        size = len(value.as_buffer()) if value.is_valid else 0
        if k > low and (held + size > SLICE_BYTES or k - low >= SLICE_ROWS):
            yield batch.slice(low, k - low)
            low, held = k, 0
        held += size
    if batch.num_rows:
        yield batch.slice(low)


def to_fill_middle(docs: DataFrame, salt: str = "1") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output) of every row of ``docs``.

    n: tokens of the text (null: empty). Two units, drawn from the id, end the
    prefix and the middle. ``form`` is plain (the text as it is) for empty
    texts, texts that hold a marker, and a tenth of the ids; else spm for a
    fifth and psm. ``output`` is the text in that form; spans are null if
    plain. A null doc_id draws as the empty string; rows of one doc_id draw
    alike. Only doc_id and text are read. No documents: no rows.
    """
    h = dict(zip(["h1", "h2", "h3", "h4"], decisions(F.col("doc_id"), salt), strict=True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("data")).withColumns(h)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.binary()]

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                texts = [t or b"" for t in part.column(1).to_pylist()]
                h1, h2, h3, h4 = (part.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6))
                n, a, b, before, inside = cut_points(texts, h1, h2)
                marked = [any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts]
                plain = (n == 0) | (h3 % 100 >= PLAIN_FROM) | np.array(marked, dtype=bool)
                form = np.where(plain, "plain", np.where(h4 % 100 < SPM_BELOW, "spm", "psm")).tolist()
                out = [_arranged(*x) for x in zip(texts, a.tolist(), b.tolist(), form, strict=True)]
                spans = [pa.array(x, pa.int64(), mask=plain) for x in (before, inside, a, b - a)]
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), *spans, pa.array(out, pa.binary())]
                yield pa.record_batch([c.cast(t) for c, t in zip(columns, types, strict=True)], names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output binary"
    made = rows.mapInArrow(arrange, schema)
    return made.withColumn("output", F.col("output").cast("string"))


def restore(made: DataFrame, name: str = "restored") -> DataFrame:
    """``made`` with the text rebuilt from its columns output and form; a null output gives null."""

    @F.pandas_udf("binary")
    def texts(output: pd.Series, form: pd.Series) -> pd.Series:
        return output.combine(form, lambda o, f: None if o is None else rebuilt(bytes(o), f))

    return made.withColumn(name, texts(F.col("output").cast("binary"), "form").cast("string"))
