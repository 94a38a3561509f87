"""License scans with a positional index of rare licence words.

Templates (short notices and base phrases) are indexed by their words of
highest inverse document frequency. The positions of these words in a file are
looked up in the template postings; postings that agree on the relative
position propose an alignment, and an alignment counts only if the template's
key phrase stands there. Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import phrase_words

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Template:
    """A notice in words, the phrase that must stand in it, and its label."""

    label: str
    text: str
    phrase: str


NOTICES = (
    Template("mit-notice", "released under the mit license", "mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
#: Index words of a template: so many of its rarest.
RARE = 3


def scan(docs: DataFrame, notices: tuple[Template, ...] = NOTICES, base: dict[str, str] | None = None, min_share: float = 0.6) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices).

    ``notices`` lists (label, start, share) of the verified alignments in which
    at least ``min_share`` of the template's words stand in place. The score is the largest share of a template's words found in place, at least
    0.5 if a base phrase stands in the text, else 0.

    A null text has no words. Every row is judged, also with a null or a
    repeated doc_id (equal rows get equal results). Other columns are not
    read. No documents: no rows. Templates without words are refused.
    """
    base = BASE if base is None else base
    every = [(f"base:{label}", text, text) for text, label in base.items()] + [(f"notice:{t.label}", t.text, t.phrase) for t in notices]
    split = [(name, text.split(), phrase.split()) for name, text, phrase in every]
    if any(not words or f" {' '.join(phrase)} " not in f" {' '.join(words)} " for _, words, phrase in split):
        raise ValueError("a template needs words, and its phrase must stand in it")
    spark = docs.sparkSession
    vocabulary = sorted({w for _, words, _ in split for w in words})
    longest = max(len(words) for _, words, _ in split)

    files = docs.select("doc_id", F.xxhash64("text").alias("digest"), phrase_words(F.col("text")).alias("words"))
    # document frequency of the licence words over all files; at most one row per licence word
    counted = (
        files.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("word")).groupBy("word").count().collect()
    )
    df = dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in counted}

    postings = []  # (word, template, place of the word): a few for each template
    for name, words, phrase in split:
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        rare = sorted(set(phrase), key=lambda w: (df[w], w))[:RARE]
        postings += [(w, name, i, words, at, phrase, len(rare)) for i, w in enumerate(words) if w in rare and at <= i < at + len(phrase)]
    index = spark.createDataFrame(postings, "word string, template string, place int, t_words array<string>, phrase_at int, phrase array<string>, rare int")

    index_words = sorted({p[0] for p in postings})
    places = (
        files.where(F.arrays_overlap("words", F.array(*map(F.lit, index_words))))
        .select("doc_id", "digest", "words", F.posexplode("words").alias("at", "word"))
        .where(F.col("word").isin(index_words))
        # what can belong to an alignment with this word: at most two template lengths
        .withColumn("low", F.greatest(F.lit(0), F.col("at") - longest))
        .withColumn("around", F.slice("words", F.col("low") + 1, F.lit(2 * longest + 1)))
        .select("doc_id", "digest", "at", "word", "low", "around")
    )
    # the index has a few rows for each template, whatever the size of the corpus
    aligned = (
        places.join(F.broadcast(index), "word")
        .withColumn("start", F.col("at") - F.col("place"))
        .groupBy("doc_id", "digest", "template", "start")
        .agg(
            F.count_distinct("word").alias("agree"),
            F.first("rare").alias("rare"),
            F.min(F.struct("at", "low", "around", "t_words", "phrase_at", "phrase")).alias("p"),
        )
        .where(F.col("agree") == F.col("rare"))
    )
    p = F.col("p")
    begin = F.col("start") + p["phrase_at"] - p["low"]
    hits = F.size(
        F.filter(
            F.sequence(F.lit(0), F.size(p["t_words"]) - 1),
            lambda i: F.get(p["t_words"], i) == F.get(p["around"], F.col("start") - p["low"] + i),
        )
    )
    verified = (
        aligned.where(begin >= 0)
        .where(F.slice(p["around"], begin + 1, F.size(p["phrase"])) == p["phrase"])
        .select(
            "doc_id",
            "digest",
            F.substring_index("template", ":", 1).alias("kind"),
            F.substring_index("template", ":", -1).alias("label"),
            F.col("start"),
            (hits / F.size(p["t_words"])).alias("share"),
        )
    )
    is_base = F.col("kind") == "base"
    found = verified.where(is_base | (F.col("share") >= min_share)).groupBy("doc_id", "digest").agg(
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.when(~is_base, F.col("share"))).alias("best"),
        F.collect_set(F.when(~is_base, F.struct("label", "start", "share"))).alias("notices"),
    )
    sizes = files.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"))
    same = sizes["doc_id"].eqNullSafe(found["doc_id"]) & (sizes["digest"] == found["digest"])
    return sizes.join(found, same, "left").select(
        sizes["doc_id"],
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "notices",
    )
