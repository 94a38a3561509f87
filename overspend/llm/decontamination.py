"""Benchmark decontamination with a distributed positional inverted index.

The index stores the postings of the test terms that matter: for each window
of a test item its rarest terms, by their count in the whole corpus. A posting
is (term, document, position) with the words around it. Postings that agree on
the offset-adjusted start of an item are intersected, and the words around the
rarest term confirm each window. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import phrase_words, saved, small

#: Terms of a window whose posting lists are intersected.
RAREST = 2
#: The mark after the last word of a file; no word is empty.
END = ""


def words_of(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, words): equal rows share a key, rows of one doc_id with other texts do not."""
    return docs.select("doc_id", F.xxhash64("text").alias("digest"), phrase_words(F.col("text")).alias("words"))


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(item_id, begin, w): all windows of ``size`` words; a shorter item, if it has words, is one window."""
    return (
        items.where("item_id IS NOT NULL")
        .select("item_id", phrase_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .withColumn("begin", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - size))))
        .select("item_id", F.xxhash64("words").alias("version"), "begin", F.slice("words", F.col("begin") + 1, size).alias("w"))
    )


def rarest_terms(windows: DataFrame, files: DataFrame) -> DataFrame:
    """Windows with ``picks``: the places of their rarest terms, rarest first.

    The counts cover every word of every document.
    """
    terms = saved(windows.select(F.explode("w").alias("term")).distinct(), "test-terms")
    counts = files.select(F.explode("words").alias("term")).join(small(terms), "term", "left_semi").groupBy("term").count()
    placed = windows.select("item_id", "version", "begin", F.posexplode("w").alias("place", "term")).join(counts, "term", "left").fillna(0, ["count"])
    order = Window.partitionBy("item_id", "version", "begin").orderBy("count", "place")  # at most one window's words
    picked = (
        placed.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= RAREST)
        .groupBy("item_id", "version", "begin")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "place", "term"))), lambda x: F.struct(x["place"], x["term"])).alias("picks"))
    )
    return windows.join(picked, ["item_id", "version", "begin"])


def positional_index(files: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """Postings (term, doc_id, digest, at, low, around) of ``terms``.

    ``around`` holds the words from position ``low`` to ``reach`` words after
    the term, so a phrase can be confirmed without reading the text again.
    If ``terms`` has END, every file has a posting of it after its last word.
    """
    return (
        files.select("doc_id", "digest", "words", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("at", "term"))
        .join(small(terms), "term", "left_semi")
        .withColumn("low", F.greatest(F.lit(0), F.col("at") - reach))
        .select("term", "doc_id", "digest", "at", "low", F.slice("words", F.col("low") + 1, F.col("at") - F.col("low") + reach + 1).alias("around"))
    )


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, digest, item_id, start, length) of every exact occurrence of a window."""
    p1, p2 = F.get("picks", F.lit(0)), F.get("picks", F.lit(1))
    tests = windows.select(
        "item_id", "version", "begin", "w", (F.col("begin") + p1["place"]).alias("first"), (F.col("begin") + p2["place"]).alias("second")
    )
    places = windows.select("item_id", "version", "begin", F.explode("picks").alias("pick")).select(
        "item_id", "version", (F.col("begin") + F.col("pick.place")).alias("place"), F.col("pick.term").alias("term")
    ).distinct()
    needs = windows.groupBy("item_id", "version").agg(F.min(F.size("picks")).alias("least"))
    aligned = (
        index.join(small(saved(places.join(needs, ["item_id", "version"]), "test-places")), "term")
        .withColumn("shift", F.col("at") - F.col("place"))  # where the item would begin
        .groupBy("doc_id", "digest", "item_id", "version", "shift")
        .agg(F.collect_list(F.struct("place", "low", "around")).alias("hits"), F.min("least").alias("least"))
        .where(F.size("hits") >= F.col("least"))
        .withColumn("places", F.col("hits.place"))
        .withColumn("hit", F.explode("hits"))
        .select("doc_id", "digest", "item_id", "version", "shift", "places", F.col("hit.place").alias("first"), "hit.low", "hit.around")
    )
    start = F.col("shift") + F.col("begin")
    return (
        aligned.join(small(saved(tests, "test-windows")), ["item_id", "version", "first"])
        .where(F.col("second").isNull() | F.array_contains("places", F.col("second")))
        .where(start >= 0)
        .where(F.slice("around", start - F.col("low") + 1, F.size("w")) == F.col("w"))
        .select("doc_id", "digest", "item_id", start.alias("start"), F.size("w").alias("length"))
    )


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """(doc_id, digest, term, other, at, other_at): both terms at most ``within`` words apart.

    ``pairs`` has columns term and other. An equi-join on blocks of ``within``
    words: each posting meets only its own and the neighbouring blocks.
    """
    block = F.lit(max(1, within))
    left = index.select("term", "doc_id", "digest", "at", F.floor(F.col("at") / block).alias("block")).join(small(saved(pairs.distinct(), "pairs")), "term")
    right = index.select(
        F.col("term").alias("other"),
        F.col("doc_id").alias("o_id"),
        F.col("digest").alias("o_digest"),
        F.col("at").alias("other_at"),
        F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("at") / block) + d)).alias("o_block"),
    )
    met = left.join(
        right,
        (left["other"] == right["other"])
        & left["doc_id"].eqNullSafe(right["o_id"])
        & (left["digest"] == right["o_digest"])
        & (left["block"] == right["o_block"]),
    )
    return met.where((F.abs(F.col("at") - F.col("other_at")) <= within) & (F.col("at") != F.col("other_at"))).select(
        "doc_id", "digest", left["term"], left["other"], "at", "other_at"
    ).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """(doc_id, digest, n_words, n_hit, items, contaminated) of every row of ``docs``.

    A document word inside any occurrence of a benchmark window is hit;
    ``items`` are the sorted ids, as strings, of the items with such windows.
    Contaminated: ``n_hit > 0`` and ``share * n_hit >= n_words``.

    Null and empty texts have no words; benchmark rows without id or words are
    ignored, repeated ones count once. Null and repeated doc_ids are judged
    row by row (equal rows alike). Other columns are not read. An empty
    benchmark hits nothing; no documents give no rows.
    """
    files = words_of(docs)
    windows = saved(rarest_terms(windows_of(benchmark, size), files), "windows")
    end = docs.sparkSession.createDataFrame([(END,)], "term string")
    terms = saved(windows.select(F.explode("picks.term").alias("term")).distinct().unionByName(end), "rare-terms")
    index = saved(positional_index(files, terms, size - 1), "postings")
    found = (
        phrase_matches(index, windows)
        .groupBy("doc_id", "digest")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    hit = found.select(F.col("doc_id").alias("h_id"), F.col("digest").alias("h_digest"), covered.cast("long").alias("n_hit"), "items")
    sizes = index.where(F.col("term") == END).select("doc_id", "digest", F.col("at").cast("long").alias("n_words"))
    joined = sizes.join(hit, sizes["doc_id"].eqNullSafe(hit["h_id"]) & (sizes["digest"] == hit["h_digest"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "digest",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
