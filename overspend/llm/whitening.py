"""Whitening of vectors by a covariance weighted with multiplicities.

Equal vectors are grouped first. Every later step works on the distinct
vectors: the sums, the covariance (a weighted product of centred blocks,
summed over the tasks), and the whitening, once for each. The whitened vectors
are then joined back to the rows. Copies weigh by their number, or by one.

Entries become integers on a fixed grid, so equal vectors are equal exactly
and sums and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, saved

# Fixed values of the grid: entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries from this size on have no exact place on the grid.
LARGEST = float(2**52 // SCALE)
#: A vector with more than one in so many of all rows is joined back by a broadcast, so at most so many are.
HOT = 1024
#: Entries of vectors that a task looks at together.
BLOCK_ENTRIES = 2_000_000


def on_grid(vectors: DataFrame, column: str, name: str) -> DataFrame:
    """``vectors`` with the array of long ``name`` for the rows that have a place on the grid; the others are left out."""
    c = F.col(column)
    # each expression is safe on its own: Spark may evaluate the grid before the filter
    placed = lambda e: e.isNotNull() & (F.abs(e.cast("double")) < LARGEST)  # noqa: E731 — NaN is not below anything
    usable = F.forall(c, placed)
    grid = F.transform(c, lambda e: F.when(placed(e), F.floor(e.cast("double") * SCALE).cast("long") + SHIFT))
    return vectors.where(c.isNotNull() & (F.size(c) > 0)).where(F.coalesce(usable, F.lit(False))).withColumn(name, grid)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with their vectors (column x) as a matrix of long."""
    rows = max(1, BLOCK_ENTRIES // d)
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield part, part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, S): weight of all distinct vectors and their weighted sums, exact."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = [0] * d, 0
        for part, x in _blocks(batches, d):
            w = part.column(part.schema.get_field_index("w")).to_numpy(zero_copy_only=False)
            weight += int(w.sum())
            # halves of 26 bits: their products with a weight below 2**31 keep clear of an overflow where 2**6 of them meet
            high, low = x >> 26, x & (2**26 - 1)
            if int(w.max(initial=0)) < 2**16 and len(x) < 2**20:
                total = [t + (int(a) << 26) + int(b) for t, a, b in zip(total, w @ high, w @ low, strict=True)]
            else:
                total = [t + int(a) for t, a in zip(total, (w.astype(object)[:, None] * x.astype(object)).sum(axis=0), strict=True)]
        yield pa.record_batch([pa.array([-1, *range(d)], pa.int32()), pa.array([Decimal(v) for v in (weight, *total)], pa.decimal128(38, 0))], ["i", "total"])

    parts = distinct.select("x", "w").mapInArrow(add, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total"))
    found = {r["i"]: int(r["total"]) for r in parts.collect()}  # one row per dimension
    return found[-1], [found[i] for i in range(d)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, with the integer part of the mean taken off exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    return (x - whole).astype(np.float64) - np.array([(s % n) / n for s in sums])


def _covariance(distinct: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """Weighted covariance of the distinct vectors, divisor n: one product of centred blocks per task, summed by Spark."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for part, x in _blocks(batches, d):
            c = _centred(x, n, sums)
            total += (c * part.column(part.schema.get_field_index("w")).to_numpy(zero_copy_only=False)[:, None]).T @ c
        yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    rows = distinct.select("x", "w").mapInArrow(product, "i int, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    cells = cells.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("j", "v"))).alias("row"))  # d entries each
    for r in cells.collect():  # d rows
        for j, v in r["row"].items():
            out[r["i"], j] = v / n
    return (out + out.T) / 2


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """Sum of (n*x - S)**2 of every vector, exact; null beyond 38 digits.

    With S = n*q + r it is n**2 * sum(y**2) - 2*n * sum(y*r) + sum(r**2) for
    y = x - q: two integer products, and a few large integers per vector.
    """
    q, r = [s // n for s in sums], [s % n for s in sums]
    y = x - np.array(q, dtype=np.int64)
    most = int(np.abs(y).max(initial=0))
    if most * most * len(q) < 2**62 and most * n * len(q) < 2**62:
        squares, mixed = (y * y).sum(axis=1).tolist(), (y @ np.array(r, dtype=np.int64)).tolist()
    else:
        big = y.astype(object)
        squares, mixed = (big * big).sum(axis=1).tolist(), (big * np.array(r, dtype=object)).sum(axis=1).tolist()
    rest = sum(v * v for v in r)
    out = [n * n * a - 2 * n * b + rest for a, b in zip(squares, mixed, strict=True)]
    return [Decimal(v) if v < 10**38 else None for v in out]


def whiten(vectors: DataFrame, components: int = 8, weights: str = "counts", id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    The entries c of a vector become x = floor(1024*c) + 100000. ``weights``
    "counts" fits on all vectors, "one" on each distinct vector once; n is the
    sum of the weights, S that of the vectors, the covariance has the divisor
    n. Components are unit eigenvectors by falling eigenvalue e, numbered from
    1. ``whitened`` is x - S/n on the component over sqrt(e), ``deviation``
    the sum of (n*x - S)**2 as decimal(38,0), null where that is too short,
    ``explained`` e over the trace, ``identity_error`` the largest entry of
    the whitened covariance minus the identity, as measured.

    Null vectors, empty ones, and vectors with null, non-finite or huge
    entries (from 2**42 on) take no part, nor do vectors of another length
    than the most frequent one (of equally frequent ones the longest). Null
    and repeated ids are rows like any others. With fewer dimensions than
    ``components`` there are as many components as dimensions. A component
    without variance (up to rounding) has a null ``whitened`` and no part in
    ``identity_error``. No usable vectors: no rows.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    plain = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("embedding"))
    rows = on_grid(plain, "embedding", "x").select("vec_id", "x")
    counted = saved(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct")
    lengths = counted.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("copies")).orderBy(F.desc("copies"), F.desc("d")).first()
    schema = "x array<long>, z array<double>, n long, deviation decimal(38,0), copies long, w long"
    spark = vectors.sparkSession
    if lengths is None:
        return rows.limit(0).select(
            "vec_id", F.lit(1).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")],
        )
    d, every = lengths["d"], lengths["copies"]
    distinct = counted.where(F.size("x") == d).withColumn("w", F.col("copies") if weights == "counts" else F.lit(1).cast("long"))
    n, sums = _sums(distinct, d)
    covariance = _covariance(distinct, d, n, sums)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d)
    trace = float(np.trace(covariance))
    sound = values[:k] > max(values[0], 0.0) * d * 1e-13
    # a component without variance stays in the result, without values
    project = np.where(sound, axes[:, :k] / np.sqrt(np.where(sound, values[:k], 1.0)), 0.0)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, d):
            z = _centred(x, n, sums) @ project
            masked = pa.array([[v if s else None for v, s in zip(row, sound.tolist(), strict=True)] for row in z.tolist()], pa.list_(pa.float64()))
            find = part.schema.get_field_index
            columns = [part.column(find("x")), masked, pa.array([n] * len(x), pa.int64()), pa.array(_deviations(x, n, sums), pa.decimal128(38, 0)), part.column(find("copies")), part.column(find("w"))]
            yield pa.record_batch(columns, ["x", "z", "n", "deviation", "copies", "w"])

    white = saved(distinct.select("x", "copies", "w").mapInArrow(whitened, schema), "whitened")
    error = _identity_error(white, n, [i for i in range(k) if sound[i]])
    explained = [float(v) / trace if trace > 0 else None for v in values[:k]]

    # most rows meet their vector in a shuffle; vectors with many rows are few and go to the rows
    rows = rows.where(F.size("x") == d)
    hot = white.where(F.col("copies") * HOT > every)
    cold = white.where(F.col("copies") * HOT <= every).select(F.xxhash64("x").alias("h"), "x", "z", "n", "deviation")
    near = rows.join(F.broadcast(hot.select("x", "z", "n", "deviation")), "x")
    far = rows.join(F.broadcast(hot.select("x")), "x", "left_anti").withColumn("h", F.xxhash64("x")).join(cold, ["h", "x"])
    joined = near.select("vec_id", "z", "n", "deviation").unionByName(far.select("vec_id", "z", "n", "deviation"))
    shares = F.array(*[F.lit(v).cast("double") for v in explained])
    return joined.select("vec_id", "n", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(shares, F.col("i")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(white: DataFrame, n: int, used: list[int]) -> float | None:
    """Largest entry of the weighted covariance of z minus the identity, over the components ``used``."""
    if not used:
        return None
    z, w = {i: F.get("z", F.lit(i)) for i in used}, F.col("w")
    means = white.agg(*[(F.sum(z[i] * w) / n).alias(f"m{i}") for i in used]).first()
    at = {i: z[i] - F.lit(means[f"m{i}"]) for i in used}
    pairs = [(i, j) for i in used for j in used if i <= j]
    entries = white.agg(*[(F.sum(at[i] * at[j] * w) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(entries[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
