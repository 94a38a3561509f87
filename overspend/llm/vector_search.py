"""Exact top-k inner products with a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it; the
distances of a pivot are cut into rings, and a (pivot, ring) is an annulus.
Blocks of queries first visit the annuli with the highest bounds. Their k-th
best scores are thresholds; the expansion then visits every annulus whose
bound, by the triangle inequality, reaches a threshold, and stops there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

PIVOTS = 16
RINGS = 4
#: Rows from which pivots are chosen (by a hash of the id); every row is indexed.
SAMPLE = 2048
BLOCK = 2048
QUERY_BLOCK = 256
#: Candidates that the first expansion visits at least, for each wanted neighbour.
FIRST = 20

#: Keys that the blocks of one annulus are dealt out by.
SALTS = 16

PAIR = "query_id long, query_key long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, key, c): floor(scale * x) of each component, equal rows once.

    Null vectors and vectors with null or non-finite components are left out.
    """
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
        .where(F.coalesce(finite, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale).cast("double")).alias("c"))
        .withColumn("key", F.xxhash64("c"))
        .dropDuplicates(["vec_id", "key"])
    )


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sampled vector farthest from those chosen."""
    if not len(sample):
        return sample
    picked = [0]
    gap = np.square(sample - sample[0]).sum(axis=1)
    while len(picked) < min(count, len(sample)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, np.square(sample - sample[picked[-1]]).sum(axis=1))
    return sample[picked]


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for k, row in enumerate(column):
        out[k, : len(row)] = row
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = np.square(x).sum(axis=1)[:, None] + np.square(pivots).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def in_order(f: pd.DataFrame) -> pd.DataFrame:
    """Rows of a query block in one order on each visit: sums of floats depend on it."""
    return f.sort_values(["vec_id", "key"], ignore_index=True)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` highest scores.

    The score is the inner product of the integer vectors; ties go to the
    smaller vec_id. Candidates are all rows but those with the query's id;
    with fewer than ``k``, all are returned. ``is_query`` is a condition on
    ``vec_id``. Shorter vectors are filled with zeros, an empty one is zero.
    Null ids take no part; equal rows count once; rows of one id with
    different vectors are candidates each, and a query of that id merges
    theirs. Other columns are not read. Empty input gives an empty result.
    """
    spark = vectors.sparkSession
    data = saved(integer_vectors(vectors, id_col, vec_col, scale), "vectors")
    width, most = data.agg(F.max(F.size("c")), F.max(F.greatest(F.abs(F.array_max("c")), F.abs(F.array_min("c"))))).first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    most = most or 0.0
    if width * most * most >= 2.0**62:
        raise ValueError("scores would not fit 64 bits")
    kind = "<f4" if width * most * most < 2**24 else "<f8" if width * most * most < 2**53 else "<i8"  # exact in each

    sample = data.orderBy(F.xxhash64("vec_id"), "key").limit(SAMPLE).toPandas()  # bounded
    pivots = choose_pivots(_matrix(sample["c"], width), PIVOTS)

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            gaps = _distances(_matrix(f["c"], width), pivots)
            yield f.assign(pivot=gaps.argmin(axis=1).astype("int32"), distance=gaps.min(axis=1))

    index = data.mapInPandas(keyed, "vec_id long, c array<double>, key long, pivot int, distance double")
    index = saved(index, "pivot-distances")
    cuts = {
        r["pivot"]: r["cuts"]
        for r in index.groupBy("pivot").agg(F.percentile_approx("distance", [i / RINGS for i in range(1, RINGS)]).alias("cuts")).collect()
    }
    edges = F.create_map(*[x for p, c in cuts.items() for x in (F.lit(p), F.array(*map(F.lit, c)))])
    ring = F.size(F.filter(edges[F.col("pivot")], lambda e: e < F.col("distance")))
    index = index.withColumn("ring", ring).withColumn("annulus", F.col("pivot") * RINGS + F.col("ring"))
    norm = F.aggregate("c", F.lit(0.0), lambda a, v: a + v * v)
    annuli = (  # at most PIVOTS * RINGS rows
        index.groupBy("annulus", "pivot")
        .agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"), F.max(norm).alias("norm"))
        .orderBy("annulus")
        .toPandas()
    )
    centres, low, high = pivots[annuli["pivot"]], annuli["low"].to_numpy(), annuli["high"].to_numpy()
    norms, counts, names = annuli["norm"].to_numpy(), annuli["n"].to_numpy(), annuli["annulus"].to_numpy()

    def bounds(q: np.ndarray) -> np.ndarray:
        """Highest score that a vector of each annulus can reach, by the triangle inequality."""
        length = np.sqrt(np.square(q).sum(axis=1))[:, None]
        to_pivot = _distances(q, centres)
        gap = np.maximum(0, np.maximum(to_pivot - high, low - to_pivot))
        by_gap = (np.square(length) + norms - np.square(gap)) / 2
        by_radius = q @ centres.T + length * high
        return np.minimum(by_gap, by_radius) + 1e-6 * (1 + length * np.sqrt(norms))

    blocks_of = {int(a): max(1, -(-int(n) // BLOCK)) for a, n in zip(names, counts, strict=True)}
    n_blocks = F.create_map(*[x for a, n in blocks_of.items() for x in (F.lit(a), F.lit(n))])
    dealt = index.withColumn("block", F.pmod(F.hash("key", "vec_id"), n_blocks[F.col("annulus")]))

    def packed_block(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "annulus": [f["annulus"].iloc[0]],
                "slice": [f["block"].iloc[0] % SALTS],
                "ids": [f["vec_id"].to_numpy().astype("<i8").tobytes()],
                "matrix": [_matrix(f["c"], width).astype(kind).tobytes()],
            }
        )

    blocks = saved(dealt.groupBy("annulus", "block").applyInPandas(packed_block, "annulus int, slice int, ids binary, matrix binary"), "blocks")

    queries = index.where(is_query).select("vec_id", "key", "c", "pivot")
    groups = {r["pivot"]: r["count"] for r in queries.groupBy("pivot").count().collect()}
    salts = F.create_map(*[x for p, n in (groups or {0: 1}).items() for x in (F.lit(p), F.lit(1 + n // QUERY_BLOCK))])
    queries = queries.withColumn("salt", F.pmod(F.hash("key", "vec_id"), salts[F.col("pivot")]))

    def visits(first: bool):
        schema = "annulus int, q_ids binary, q_keys binary, q_matrix binary, q_least binary"

        def plan(f: pd.DataFrame) -> pd.DataFrame:
            f = in_order(f)
            q = _matrix(f["c"], width)
            reach = bounds(q)
            order = np.argsort(-reach.mean(axis=0), kind="stable")
            opening = order[: 1 + int(np.searchsorted(np.cumsum(counts[order]), FIRST * k))]
            if first:
                chosen, least = opening, np.full(len(q), -np.inf)
            else:
                least = f["least"].to_numpy(dtype=float)
                chosen = np.setdiff1d(np.flatnonzero((reach >= least[:, None]).any(axis=0)), opening)
            row = {
                "q_ids": f["vec_id"].to_numpy().astype("<i8").tobytes(),
                "q_keys": f["key"].to_numpy().astype("<i8").tobytes(),
                "q_matrix": q.astype(kind).tobytes(),
                "q_least": least.astype("<f8").tobytes(),
            }
            return pd.DataFrame([{"annulus": int(names[a]), **row} for a in chosen], columns=["annulus", *row])

        return plan, schema

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                ids, q_ids = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.q_ids, "<i8")
                keys, least = np.frombuffer(r.q_keys, "<i8"), np.frombuffer(r.q_least, "<f8")
                scores = np.frombuffer(r.q_matrix, kind).reshape(-1, width) @ np.frombuffer(r.matrix, kind).reshape(-1, width).T
                for at in range(len(q_ids)):
                    ok = np.flatnonzero((scores[at] >= least[at]) & (ids != q_ids[at]))
                    if len(ok) > k:
                        s = scores[at][ok]
                        ok = ok[s >= np.partition(s, len(s) - k)[len(s) - k]]  # ties stay, the smaller ids are taken next
                        ok = ok[np.lexsort((ids[ok], -scores[at][ok]))[:k]]
                    if len(ok):
                        yield pd.DataFrame({"query_id": q_ids[at], "query_key": keys[at], "vec_id": ids[ok], "score": scores[at][ok].astype("int64")})

    def expand(rows: DataFrame, first: bool) -> DataFrame:
        plan, schema = visits(first)
        asked = rows.groupBy("pivot", "salt").applyInPandas(plan, schema)
        slices = F.least(n_blocks[F.col("annulus")], F.lit(SALTS))
        asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        return asked.join(blocks, ["annulus", "slice"]).select("ids", "matrix", "q_ids", "q_keys", "q_matrix", "q_least").mapInPandas(compare, PAIR)

    def best(found: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    opened = saved(best(expand(queries, True), "query_id", "query_key").drop("rank"), "first-visits")
    least = (
        opened.groupBy("query_id", "query_key")
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(float("-inf")).alias("least"))
        .select(F.col("query_id").alias("vec_id"), F.col("query_key").alias("key"), "least")
    )
    again = queries.join(least, ["vec_id", "key"], "left").fillna(float("-inf"), ["least"])
    found = opened.unionByName(expand(again, False)).select("query_id", "vec_id", "score")
    return best(found, "query_id").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
