"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics (native column
expressions). Class sums and cross products over all labelled training rows
give means and covariances; each covariance is shrunk towards the pooled one
and its diagonal. A score is the sigmoid of the difference of the two Gaussian
log densities, from cached Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: Pseudo-counts: shares of a short text lean to a usual value.
LEAN = 40.0


def features(text: Column) -> Column:
    """Array of transformed statistics of a text; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t).cast("double")
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    lines = F.split(t, "\n")
    n_words = F.size(words).cast("double")
    n_lines = F.size(lines).cast("double")

    def without(pattern: str) -> Column:  # characters that the pattern removes
        return n - F.length(F.regexp_replace(t, pattern, ""))

    def share(count: Column, of: Column, usual: float) -> Column:
        return F.sqrt((count + usual * LEAN) / (of + LEAN))

    letters = without(r"\p{L}+")
    runs = F.regexp_count(t, F.lit(r"[^\p{L}\p{N}\s]{2,}")).cast("double")
    symbols = without(r"[#$%&*+/<=>@\\^_`{|}~\[\]!]+")
    repeats = F.aggregate(
        words,
        F.struct(F.lit("").alias("last"), F.lit(0.0).alias("n")),
        lambda a, w: F.struct(w.alias("last"), (a["n"] + F.when(a["last"] == w, 1.0).otherwise(0.0)).alias("n")),
        lambda a: a["n"],
    )
    return F.array(
        F.log1p(n),
        F.log((n + 6 * LEAN) / (n_words + LEAN)),
        share(letters, n, 0.8),
        share(without(r"\p{Lu}+"), letters, 0.03),
        share(without(r"\p{N}+"), n, 0.005),
        share(without(r"[^\p{L}\p{N}\s]+"), n, 0.02),
        share(symbols, n, 0.001),
        share(runs, n_words, 0.002),
        share(repeats, n_words, 0.005),
        F.log((F.size(F.array_distinct(words)) + LEAN) / (n_words + LEAN)),
        share(n_lines - F.size(F.array_distinct(lines)), n_lines, 0.01),
        F.log((n + 200.0) / (n_lines + 1.0)),
    )


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians: means, inverse Cholesky factors, log constants; a plain share where a class is absent."""

    share: float
    means: tuple[np.ndarray, ...] = ()
    inverses: tuple[np.ndarray, ...] = ()
    constants: tuple[float, ...] = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        logs = [
            c - 0.5 * np.square((x - m) @ inv.T).sum(axis=1)
            for m, inv, c in zip(self.means, self.inverses, self.constants, strict=True)
        ]
        # rounded, so that the order of additions in a batch does not show
        return np.round(1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -500, 500))), 9)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", pooled: float = 0.1, diagonal: float = 0.1, ridge: float = 1e-4) -> Discriminant:
    """Fit on every labelled row of ``docs``; only class sums reach the driver.

    ``pooled`` and ``diagonal`` are the shrinkage weights. Rows with a null
    doc_id or label, or a label other than 0 and 1, are not used; of several
    labels of a document the smallest counts. If a class has fewer than two
    rows, the model is the share of label 1 (0.5 without labels).
    """
    known = labels.where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    x = docs.select("doc_id", features(F.col("text")).alias("x")).join(known, "doc_id").select("y", F.concat(F.array(F.lit(1.0)), "x").alias("x"))

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for y, part in frame.groupby("y"):
                m = np.stack(part["x"].to_numpy())
                total[y] = total.get(y, 0) + m.T @ m
        for y, m in total.items():
            yield pd.DataFrame({"y": y, "at": np.arange(m.size), "v": m.ravel()})

    sums = x.mapInPandas(moments, "y int, at int, v double").groupBy("y", "at").agg(F.sum("v").alias("v")).collect()
    by = {y: np.array([r["v"] for r in sorted((r for r in sums if r["y"] == y), key=lambda r: r["at"])]) for y in (0, 1)}
    grams = {y: v.reshape(int(len(v) ** 0.5), -1) for y, v in by.items() if len(v)}
    counts = [grams[y][0, 0] if y in grams else 0.0 for y in (0, 1)]
    share = counts[1] / sum(counts) if sum(counts) else 0.5
    if min(counts) < 2:
        return Discriminant(share)
    means = [grams[y][0, 1:] / counts[y] for y in (0, 1)]
    covs = [grams[y][1:, 1:] / counts[y] - np.outer(means[y], means[y]) for y in (0, 1)]
    both = (covs[0] * counts[0] + covs[1] * counts[1]) / sum(counts)
    inverses, constants = [], []
    for y in (0, 1):
        c = (1 - pooled) * covs[y] + pooled * both
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + ridge * np.eye(len(c))
        factor = np.linalg.cholesky(c)
        inverses.append(np.linalg.inv(factor))
        constants.append(float(np.log(counts[y] / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Discriminant(share, tuple(means), tuple(inverses), tuple(constants))


def with_score(docs: DataFrame, model: Discriminant, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: label 1 likelier); every row and column stays."""
    at = free_name(docs, "features")

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else np.empty(0))

    # features see whole texts only: no label, language, source or id
    return docs.withColumn(at, features(F.col("text"))).withColumn(name, score(F.col(at))).drop(at)


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves remainder 2 by 4. A null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Learns from labelled rows that are not held out. Null and empty texts are
    scored as empty; a null or repeated doc_id is scored row by row; other
    columns, also ones named like the results, are not read.
    """
    docs = docs.select("doc_id", "text")
    model = fit(docs.where(~held_out(F.col("doc_id"))), labels)
    return with_score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
