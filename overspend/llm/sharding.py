"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows each source partition sends to each shard is drawn first: the
matrix of a uniform random permutation, whose rows add up to the partitions
and whose columns add up to the shards. The rows of a partition are then
permuted locally and dealt out by these counts, exchanged, and permuted once
more in their shard.

The matrix is drawn by halving the list of partitions: the left half's part of
every shard is hypergeometric, given what the two halves hold together. The
nodes of one level are independent rows of a table, so a level is one
distributed step, and the driver sees none of the counts. Draws follow from a
hash of (seed, node, shard): a task that runs again draws the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, saved, small

#: Rows that are numbered together in a shard.
BLOCK_ROWS = 4096
#: Standard deviations around the expected count that a draw can reach (what lies beyond has a probability under 1e-30).
REACH = 12.0


def unit(*parts: Column | int) -> Column:
    """A number in [0, 1) with 53 bits from a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body is evaluated many times."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``: the value where the inverse of the distribution takes ``u``.

    The weights of the counts are followed outwards from the expected count by
    their exact ratios: once to add them up, once to find the one that u of
    the sum falls on. Impossible counts get the weight 0.
    """
    one = F.lit(1.0)
    # weights are products of ratios, so they are doubles; counts below 2**53 are exact in them
    given = F.struct(total.cast("double").alias("t"), marked.cast("double").alias("m"), drawn.cast("double").alias("n"), u.alias("u"))

    def centred(g: Column) -> Column:
        t, m, n = g["t"], g["m"], g["n"]
        share = m / F.greatest(t, one)
        centre = F.greatest(n - (t - m), F.lit(0.0), F.least(n, m, F.floor(n * share).cast("double")))
        sd = F.sqrt(F.greatest(n * share * (1 - share) * (t - n) / F.greatest(t - 1, one), F.lit(0.0)))
        steps = F.least(F.ceil(sd * REACH) + 8, F.greatest(n, one).cast("long"))
        v = F.struct(m.alias("m"), n.alias("n"), (t - m - n).alias("rest"), g["u"].alias("u"), centre.alias("centre"), F.sequence(F.lit(1).cast("long"), steps).alias("steps"))
        return let(v, chosen)

    def chosen(v: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            """Weights of the counts ``i`` above and below the centre, from those of the step before."""
            up, down = v["centre"] + i - 1, v["centre"] - i + 1
            higher = s["up"] * ((v["m"] - up) / (up + 1)) * ((v["n"] - up) / (v["rest"] + up + 1))
            lower = s["down"] * (down / (v["m"] - down + 1)) * ((v["rest"] + down) / (v["n"] - down + 1))
            return F.struct(higher.alias("up"), lower.alias("down"))

        def add(s: Column, i: Column) -> Column:
            return let(step(s, i), lambda w: F.struct(w["up"].alias("up"), w["down"].alias("down"), (s["sum"] + w["up"] + w["down"]).alias("sum")))

        def seek(s: Column, i: Column) -> Column:
            def next_of(w: Column) -> Column:
                left = s["left"] - w["up"]
                found = F.when(s["found"].isNotNull(), s["found"]).when(left < 0, v["centre"] + i).when(left - w["down"] < 0, v["centre"] - i)
                return F.struct(w["up"].alias("up"), w["down"].alias("down"), (left - w["down"]).alias("left"), found.alias("found"))

            return let(step(s, i), next_of)

        mass = F.aggregate(v["steps"], F.struct(one.alias("up"), one.alias("down"), one.alias("sum")), add)["sum"]

        def picked(target: Column) -> Column:
            start = F.struct(one.alias("up"), one.alias("down"), target.alias("left"), F.when(target < 0, v["centre"]).alias("found"))
            return F.coalesce(F.aggregate(v["steps"], start, seek)["found"], v["centre"]).cast("long")

        return let(v["u"] * mass - 1, picked)

    return let(given, centred)


def _left_counts(counts: Column, total: Column, left: Column, seed: int, level: int, node: Column) -> Column:
    """The left child's part of every shard, shard by shard out of what is still undrawn."""

    def draw(s: Column, c: Column) -> Column:
        def with_draw(k: Column) -> Column:
            return F.struct((s["total"] - c).alias("total"), (s["drawn"] - k).alias("drawn"), F.array_append(s["counts"], k).alias("counts"))

        return let(hypergeometric(s["total"], c, s["drawn"], unit(seed, level, node, F.size(s["counts"]))), with_draw)

    start = F.struct(total.alias("total"), left.alias("drawn"), F.array().cast("array<long>").alias("counts"))
    return F.aggregate(counts, start, draw)["counts"]


def communication_matrix(partitions: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """(part, counts): rows that each source partition sends to each shard.

    ``partitions`` has part (from 0) and n, its rows. Shard sizes differ by at
    most one; the first ones are the larger. Partitions without rows may be
    left out. No partitions: no rows.
    """
    bounds = partitions.agg(F.max("part").alias("last"), F.sum("n").alias("rows")).first()
    if not bounds["rows"]:
        return partitions.sparkSession.createDataFrame([], "part long, counts array<long>")
    levels = int(bounds["last"]).bit_length()
    above = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("up")
    totals = partitions.select("part", "n", above).groupBy("up", F.expr("shiftright(part, up)").alias("node")).agg(F.sum("n").alias("n"))
    totals = saved(totals, "totals")
    rows = bounds["rows"]
    sizes = [rows // shards + (k < rows % shards) for k in range(shards)]
    matrix = totals.where(F.col("up") == levels).select("node", "n", F.array(*[F.lit(x).cast("long") for x in sizes]).alias("counts"))
    for up in range(levels - 1, -1, -1):
        left = totals.where(F.col("up") == up).select((F.col("node") / 2).cast("long").alias("parent"), "node", "n").where("node % 2 = 0")
        split = matrix.join(left.select(F.col("parent").alias("node"), F.col("n").alias("n_left")), "node", "left")
        split = split.withColumn("n_left", F.coalesce("n_left", F.lit(0).cast("long")))
        mine = split.withColumn("left", _left_counts(F.col("counts"), F.col("n"), F.col("n_left"), seed, up, F.col("node")))
        # the children are made behind an explode, so that no draw is computed twice
        child = F.explode(
            F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("n_left").alias("n"), F.col("left").alias("counts")),
                F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("n") - F.col("n_left")).alias("n"), F.zip_with("counts", "left", lambda a, b: a - b).alias("counts")),
            )
        ).alias("c")
        matrix = mine.select(child).select("c.*").where("n > 0")
    return saved(matrix.select(F.col("node").alias("part"), "counts"), "matrix")


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 1, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Every row of ``docs`` with its ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in the shard).

    Shards differ by at most one row. For a given input, laid out alike, the
    result is the same; rows are keyed by a hash of their columns (but maps)
    and then by their place, so which of equal rows goes where has no
    meaning. Nulls, empty texts, repeated rows and extra columns are rows like
    any others; a column named as ``shard`` or ``slot`` is replaced. Fewer
    rows than shards leave the last shards empty. No documents: no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    docs = docs.drop(shard, slot)
    names = [free_name(docs, x) for x in ("__part", "__place", "__key", "__block", "__start")]
    part, place, key, block, begin = names
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]

    # local permutation: no row leaves its partition; the id is the partition's number and the place in it
    local = docs.withColumn(key, F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in hashed])).sortWithinPartitions(key)
    numbered = local.withColumn(place, F.monotonically_increasing_id()).withColumn(part, F.shiftright(place, 33))
    rows = saved(numbered.withColumn(place, F.col(place) - F.shiftleft(part, 33)).drop(key), "permuted")

    partitions = rows.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    matrix = communication_matrix(partitions, shards, seed)
    # rows of a partition go to the shards in the order of their places: running totals bound the shards
    ends = F.aggregate("counts", F.array(F.lit(0).cast("long")), lambda s, c: F.array_append(s, F.element_at(s, -1) + c))
    bounds = matrix.select(F.col("part").alias(part), F.slice(ends, 2, shards).alias(begin))
    to = F.size(F.filter(begin, lambda e: e <= F.col(place)))
    sent = rows.join(small(bounds), part).withColumn(shard, to.cast("int")).drop(begin)

    # second permutation: blocks of each shard by a fresh hash, numbered one after the other
    n_blocks = F.lit(max(1, -(-_rows(matrix) // (shards * BLOCK_ROWS)))).cast("long")
    sent = sent.withColumn(key, F.xxhash64(F.lit(seed), F.lit("exchange"), part, place)).withColumn(block, F.pmod(F.col(key), n_blocks))
    sizes = sent.groupBy(shard, block).agg(F.count(F.lit(1)).alias(begin))
    before = Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(sizes.withColumn(begin, F.coalesce(F.sum(begin).over(before), F.lit(0))), "starts")
    inside = F.row_number().over(Window.partitionBy(shard, block).orderBy(key, part, place)) - 1
    # the number inside a block comes first, so that the start is looked up after the exchange
    found = sent.withColumn(slot, inside).join(small(starts), [shard, block])
    return found.withColumn(slot, (F.col(begin) + F.col(slot)).cast("long")).select(*docs.columns, shard, slot)


def _rows(matrix: DataFrame) -> int:
    counts = F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)
    return matrix.agg(F.sum(counts)).first()[0] or 0


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 1) -> None:
    """The shuffled rows as Parquet, one folder per shard; every file is sorted by slot.

    Rows of a shard are dealt over several files by ranges of slots, so a
    shard is no task.
    """
    out = shuffle_into_shards(docs, shards, seed)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
