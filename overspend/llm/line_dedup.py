"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

The exact reference table holds one row per (line key, document). A key that
at least ``min_docs`` documents hold is *crowded*: its lines go, except in the
largest doc_id that holds it. Cuckoo filters, one per shard of the key space,
hold the fingerprints of the crowded keys. Lines are first probed against the
filter of their shard; only those that may be crowded meet the exact counts.

Both structures support inserting and deleting documents, so a batch can be
added and taken back without reading the rest of the corpus again.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, saved

BLANKS = " \t\n\x0b\x0c\r"  # fixed: bytes 20 and 09-0D
SLOTS = 4
KICKS = 400
KEYS_PER_SHARD = 100_000
LINES_PER_GROUP = 50_000


class CuckooFilter:
    """16-bit fingerprints in buckets of four, with a stash for what finds no place.

    ``contains`` has no false negatives. Deleting a key that was inserted
    removes one copy of its fingerprint.
    """

    def __init__(self, cells: np.ndarray, stash: list[int]) -> None:
        self.cells, self.stash = cells, stash

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), dtype="<u2"), [])

    @classmethod
    def load(cls, cells: bytes, stash: bytes) -> CuckooFilter:
        return cls(np.frombuffer(cells, dtype="<u2").reshape(-1, SLOTS).copy(), np.frombuffer(stash, dtype="<u8").tolist())

    def dump(self) -> tuple[bytes, bytes]:
        return self.cells.tobytes(), np.array(self.stash, dtype="<u8").tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        print_ = ((h >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.int64)
        print_[print_ == 0] = 1
        first = ((h >> np.uint64(8)) & np.uint64(len(self.cells) - 1)).astype(np.int64)
        return print_, first, self.other(first, print_)

    def other(self, bucket, print_):
        return bucket ^ ((print_ * 0x5BD1E995) >> 7 & (len(self.cells) - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, first, second = self.places(keys)
        found = (self.cells[first] == print_[:, None]).any(axis=1) | (self.cells[second] == print_[:, None]).any(axis=1)
        if self.stash:
            found |= np.isin(np.minimum(first, second) << 16 | print_, np.array(self.stash, dtype=np.int64))
        return found

    def insert(self, keys: np.ndarray) -> None:
        for p, a, b in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            at = a
            for kick in range(KICKS):
                for bucket in (a, b) if kick == 0 else (at,):
                    free = np.flatnonzero(self.cells[bucket] == 0)
                    if len(free):
                        self.cells[bucket, free[0]] = p
                        break
                else:
                    slot = (p + kick) % SLOTS
                    p, self.cells[at, slot] = int(self.cells[at, slot]), p
                    at = int(self.other(at, p))
                    continue
                break
            else:
                self.stash.append(min(at, int(self.other(at, p))) << 16 | p)

    def delete(self, keys: np.ndarray) -> None:
        for p, a, b in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            for bucket in (a, b):
                hit = np.flatnonzero(self.cells[bucket] == p)
                if len(hit):
                    self.cells[bucket, hit[0]] = 0
                    break
            else:
                if (mark := min(a, b) << 16 | p) in self.stash:
                    self.stash.remove(mark)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(k1, k2, doc_id, digest, at): lines whose key is long enough, as 128-bit hashes."""
    key = F.col("key")
    return (
        docs.where("doc_id IS NOT NULL")
        .select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.length(key) >= min_chars)
        # k2 must not follow from k1: more arguments would only be hashed with k1 as the seed
        .select(F.xxhash64(key).alias("k1"), F.xxhash64(F.concat(F.lit("#"), key)).alias("k2"), "doc_id", "digest", "at")
    )


def _crowded(holders: DataFrame, min_docs: int) -> DataFrame:
    return holders.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= min_docs)


@dataclass(frozen=True)
class LineIndex:
    """A version of the index. ``insert`` and ``delete`` return a new one; the old one stays valid.

    holders: (k1, k2, doc_id), one row per key and document (exact).
    crowded: (k1, k2, docs, last), the exact counts of the crowded keys.
    filters: (shard, cells, stash), the cuckoo filter of each shard.
    """

    holders: DataFrame
    crowded: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int

    def _shard(self) -> Column:
        return F.pmod(F.col("k1"), F.lit(self.shards)).cast("int")

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents; a doc_id that is there already gains the new lines."""
        new = _lines(docs, self.min_chars).select("k1", "k2", "doc_id").distinct()
        return self._moved(self.holders.unionByName(new).distinct(), new)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take back all lines of the documents in ``doc_ids`` (column doc_id)."""
        ids = doc_ids.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct()
        return self._moved(self.holders.join(ids, "doc_id", "left_anti"), self.holders.join(ids, "doc_id", "left_semi"))

    def _moved(self, holders: DataFrame, touched: DataFrame) -> LineIndex:
        holders = saved(holders.select("k1", "k2", "doc_id"), "line-holders")
        keys = touched.select("k1", "k2").distinct()
        now = _crowded(holders.join(keys, ["k1", "k2"], "left_semi"), self.min_docs)
        crowded = saved(self.crowded.join(keys, ["k1", "k2"], "left_anti").unionByName(now), "line-counts")
        changes = (
            self.crowded.select("k1", "k2", F.lit(-1).alias("change"))
            .unionByName(crowded.select("k1", "k2", F.lit(1).alias("change")))
            .groupBy("k1", "k2")
            .agg(F.sum("change").alias("change"))
            .where("change <> 0")
            .withColumn("shard", self._shard())
        )

        def update(_: tuple, old: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
            if old.empty:
                filter_ = CuckooFilter.sized(max(1024, 2 * len(moves)))
            else:
                filter_ = CuckooFilter.load(old["cells"].iloc[0], old["stash"].iloc[0])
            filter_.delete(moves.loc[moves["change"] < 0, "k1"].to_numpy())
            filter_.insert(moves.loc[moves["change"] > 0, "k1"].to_numpy())
            cells, stash = filter_.dump()
            shard = (old if len(old) else moves)["shard"].iloc[0]
            return pd.DataFrame({"shard": [shard], "cells": [cells], "stash": [stash]})

        filters = self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, "shard int, cells binary, stash binary")
        return replace(self, holders=holders, crowded=crowded, filters=saved(filters, "line-filters"))

    def drops(self, docs: DataFrame) -> DataFrame:
        """(doc_id, digest, drop): the line numbers that go, for documents that lose lines."""
        return self._drops(_lines(docs, self.min_chars))

    def _drops(self, lines: DataFrame) -> DataFrame:
        lines = lines.withColumn("shard", self._shard())
        # as many groups as needed to bound their size, also where one line is very common
        most = lines.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        salts = 1 + most // LINES_PER_GROUP
        dealt = lines.withColumn("salt", F.pmod(F.hash("doc_id", "at"), F.lit(salts)))
        filters = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def probe(_: tuple, rows: pd.DataFrame, filter_: pd.DataFrame) -> pd.DataFrame:
            if rows.empty or filter_.empty:
                return rows.iloc[:0, :5]
            cuckoo = CuckooFilter.load(filter_["cells"].iloc[0], filter_["stash"].iloc[0])
            return rows.loc[cuckoo.contains(rows["k1"].to_numpy()), ["k1", "k2", "doc_id", "digest", "at"]]

        maybe = dealt.groupBy("shard", "salt").cogroup(filters.groupBy("shard", "salt")).applyInPandas(probe, "k1 long, k2 long, doc_id long, digest long, at int")
        return (
            maybe.join(self.crowded, ["k1", "k2"])  # exact: no false positive stays
            .where(F.col("doc_id") != F.col("last"))
            .groupBy("doc_id", "digest")
            .agg(F.collect_set("at").alias("drop"))
        )

    def clean(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``text`` less its crowded lines; see :func:`dedup_lines`."""
        return _without(docs, self.drops(docs))


def build(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> LineIndex:
    """The index of a first batch of documents."""
    index = _build(_lines(docs, min_chars), min_docs, min_chars)
    return replace(index, holders=saved(index.holders, "line-holders"), filters=saved(index.filters, "line-filters"))


def _build(lines: DataFrame, min_docs: int, min_chars: int) -> LineIndex:
    """The index with only its counts written; the rest is computed where it is used."""
    holders = lines.select("k1", "k2", "doc_id").distinct()
    crowded = saved(_crowded(holders, min_docs), "line-counts")
    shards = 1 + crowded.count() // KEYS_PER_SHARD

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        filter_ = CuckooFilter.sized(max(1024, 2 * len(frame)))  # room for later batches
        filter_.insert(frame["k1"].to_numpy())
        cells, stash = filter_.dump()
        return pd.DataFrame({"shard": frame["shard"].iloc[:1].to_numpy(), "cells": [cells], "stash": [stash]})

    by_shard = crowded.withColumn("shard", F.pmod(F.col("k1"), F.lit(shards)).cast("int")).groupBy("shard")
    filters = by_shard.applyInPandas(fill, "shard int, cells binary, stash binary")
    return LineIndex(holders, crowded, filters, shards, min_docs, min_chars)


def _without(docs: DataFrame, drops: DataFrame) -> DataFrame:
    names = ("digest", "drop", "dropped", "__id", "__digest", "__n_lines", "__n_dropped")
    digest, drop, gone, of, with_digest, n_lines, n_dropped = (free_name(docs, x) for x in names)
    d = drops.select(F.col("doc_id").alias(of), F.col("digest").alias(with_digest), F.col("drop").alias(gone))
    keyed = docs.withColumn(digest, F.xxhash64("text"))
    joined = keyed.join(d, (F.col(of) == keyed["doc_id"]) & (F.col(with_digest) == keyed[digest]), "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return (
        joined.withColumn(drop, F.coalesce(F.size(gone), F.lit(0)))
        .withColumn(n_lines, F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
        .withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept))
        .select(*docs.columns, n_lines, F.col(drop).cast("long").alias(n_dropped))
    )


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """All columns of ``docs``, ``text`` less its crowded lines, ``__n_lines`` and ``__n_dropped``.

    A line's key is the line without blanks at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points in at least ``min_docs``
    documents (distinct doc_ids) lose all lines, repeated ones too, except in
    the largest doc_id. A null text stays null and counts as one empty line.
    Rows with a null doc_id hold no line and lose none. Equal rows are treated
    alike; rows of one doc_id with different texts count as one document.
    Extra columns stay as they are; where one is named ``__n_lines`` or
    ``__n_dropped``, the count gets one more leading underscore. An empty
    table gives an empty result.
    """
    lines = saved(_lines(docs, min_chars), "lines")
    return _without(docs, _build(lines, min_docs, min_chars)._drops(lines))
