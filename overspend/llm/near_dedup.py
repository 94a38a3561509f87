"""Near-dedup by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets are one
representative. Independent trees branch the representatives: at a node, one
or two coordinates of a minwise signature are selected by a hash of the node,
and each of their values is a child. Pairs above the similarity survive each
level with an expected count of at least one, others die out.

Each document first meets the smallest member it shares most nodes with. Nodes
with few members outside their largest component are then compared, these
members with all others. Other nodes are crowded; those that share members are
one crowd. A crowd of a few blocks is compared whole, on full sets: this costs
less than to branch its members once more. The members of larger crowds get
deeper trees, each with a signature of its own and as many trees as the depth
needs. At the last depth crowds of any size are compared whole. Pairs that one
crowd holds are left to it. Every link is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import LOWER, UPPER, saved, small
from .components import connected_components

COORDINATES = 64
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240517)
_MULTIPLY = _RNG.integers(1, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
#: Least share of pairs at the least similarity that trees below the first depth may lose.
MISS = 1e-6
#: Texts whose sets a task holds at a time.
SLICE_ROWS = 500
#: Members of a block of a crowd, and shingles of its sets.
CROWD_BLOCK = 1024
CROWD_ITEMS = 500_000
#: Blocks of the largest crowd that is compared whole before the last depth. Measured on families of 150 shingles, a member of
#: a crowd of b blocks takes (b + 1) * 0.16 ms, and 1.4 ms to branch in the trees of depth 9, which also make 416 rows of it.
CROWD_BLOCKS = 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@dataclass(frozen=True)
class Settings:
    """words: shingle length; percent: least similarity; trees: repetitions at the first depth, and the fewest at others;
    depths: levels of the trees after which nodes are compared; small: most members outside a node's largest component that are compared with all others;
    pairs: most pairs that this makes in a node, larger nodes are crowded;
    whole: blocks of the largest crowd that is compared whole before the last depth, others go to the deeper trees;
    estimate: least share of equal coordinates of a candidate (of 64; a pair at 75 % misses 45 % once in 10 million)."""

    words: int = 5
    percent: int = 75
    trees: int = 20
    depths: tuple[int, ...] = (4, 9)
    small: int = 12
    pairs: int = 768
    whole: int = 0
    estimate: float = 0.45


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles.

    A-Z are lower-cased; words are runs of bytes other than 20 and 09-0D. A
    shorter text is one shingle, a text without words none.
    """
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), dtype=np.uint8)
    inside = np.concatenate(([False], ~_SPACE[b], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    # word hash: polynomial in an odd base, by prefix sums of descending powers
    down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(b), _BASE_INVERSE, dtype=np.uint64))))
    up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(b), _BASE, dtype=np.uint64))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * down[:-1])))
    word = mix((sums[end] - sums[start]) * up[start] + (end - start).astype(np.uint64))
    n = min(words, len(word))
    total = np.zeros(len(word) - n + 1, dtype=np.uint64)
    for k in range(n):
        total = mix(total * _PLACE[k % 64] + word[k : len(word) - n + 1 + k])
    return np.unique(mix(total + np.uint64(n)))


def trees_at(s: Settings, depth: int) -> int:
    """Independent trees of which a pair at the least similarity shares no node of ``depth`` with probability MISS at most."""
    p, lost = s.percent / 100, 0.0
    for _ in range(depth):
        lost = (1 - p + p * lost) * (1 - p / 3 + p / 3 * lost)
    return s.trees if lost == 0 else max(s.trees, ceil(log(MISS) / log(lost)))


def coordinates(depth: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash functions of one tree of its own."""
    rng = np.random.default_rng([20240517, depth, tree])
    return rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def signature(items: np.ndarray, multiply: np.ndarray = _MULTIPLY, add: np.ndarray = _ADD) -> np.ndarray:
    """Minimum of each coordinate's hash over a set."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(items), 2048):
        low = np.minimum(low, (items[k : k + 2048, None] * multiply + add).min(axis=0))
    return (mix(low) >> np.uint64(32)).astype("<u4")


def digests(items: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a set."""
    return int(mix(items).sum(dtype=np.uint64).view(np.int64)), int(mix(items * _PLACE[0]).sum(dtype=np.uint64).view(np.int64))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, digest, n_shingles, d1, d2, sig): hash of the text; size, 128-bit digest and signature of each set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "digest", "n_shingles", "d1", "d2", "sig"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for low in range(0, batch.num_rows, 4 * SLICE_ROWS):
                part, rows = batch.slice(low, 4 * SLICE_ROWS), []
                for doc_id, digest, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    s = shingles(text.as_py(), words)
                    rows.append((doc_id, digest, len(s), *digests(s), signature(s).tobytes() if len(s) else None))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), F.col("text").cast("string")).mapInArrow(
        sketch, "doc_id long, digest long, n_shingles long, d1 long, d2 long, sig binary"
    )


def paths(sig: np.ndarray, tree: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, node at level ``depth``) of every chosen path of one tree."""
    row = np.arange(len(sig))
    node = np.full(len(sig), mix(np.array([tree + 1], dtype=np.uint64))[0], dtype=np.uint64)
    used = np.zeros(len(sig), dtype=np.uint64)
    for _ in range(depth):
        branches = []
        for branch in (0, 1):
            take = np.ones(len(row), dtype=bool) if branch == 0 else mix(node + np.uint64(7)) % np.uint64(3) == 0
            at, u = node[take], used[take]
            pick = mix(at + np.uint64(11 + branch)) % np.uint64(COORDINATES)
            for _ in range(COORDINATES):  # on to the next coordinate that this path has not used
                taken = (u >> pick) & np.uint64(1) == 1
                if not taken.any():
                    break
                pick = np.where(taken, (pick + np.uint64(1)) % np.uint64(COORDINATES), pick)
            value = sig[row[take], pick.astype(np.int64)].astype(np.uint64)
            child = mix(mix(at + pick + np.uint64(1)) + value)
            branches.append((row[take], child, u | (np.uint64(1) << pick)))
        row, node, used = (np.concatenate(x) for x in zip(*branches, strict=True))
    return row, node


def nodes(reps: DataFrame, trees: int, depth: int) -> DataFrame:
    """(node, rep) of all trees, over the signature of ``reps``."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rep = batch.column(0).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u4").reshape(-1, COORDINATES)
            for k in range(0, len(rep), 2000):
                for tree in range(trees):
                    row, node = paths(sig[k : k + 2000], tree, depth)
                    columns = [node.view(np.int64), rep[k : k + 2000][row]]
                    yield pa.record_batch([pa.array(c) for c in columns], ["node", "rep"])

    return reps.select("rep", "sig").mapInArrow(branch, "node long, rep long")


def own_nodes(sets: DataFrame, trees: int, depth: int) -> DataFrame:
    """(node, rep) of trees that have a signature each, over the full ``sets``; distinct, if each rep has one row."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [coordinates(depth, tree) for tree in range(trees)]
        for batch in batches:
            rep = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(rep), 500):
                items = [x.values.to_numpy().view(np.uint64) for x in batch.column(1)[k : k + 500]]
                for tree in range(trees):
                    sig = np.stack([signature(x, *hashes[tree]) for x in items])
                    row, node = paths(sig, tree, depth)
                    twice = pd.DataFrame({"row": row, "node": node}).duplicated().to_numpy()  # two branches chose one coordinate
                    columns = (node[~twice].view(np.int64), rep[k : k + 500][row[~twice]])
                    yield pa.record_batch([pa.array(c) for c in columns], ["node", "rep"])

    return sets.select("rep", "items").mapInArrow(branch, "node long, rep long")


def _equal_share(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    x, y = (np.frombuffer(b"".join(s), dtype="<u4").reshape(-1, COORDINATES) for s in (a, b))
    return pd.Series((x == y).mean(axis=1))


def _similar(pairs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity, with ``estimate``."""
    left = reps.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((F.col("n_a") * 100 >= F.col("n_b") * s.percent) & (F.col("n_b") * 100 >= F.col("n_a") * s.percent))
        .withColumn("estimate", F.pandas_udf(_equal_share, DoubleType())("sig_a", "sig_b"))
        .where(F.col("estimate") >= s.estimate)
        .select("a", "b", "estimate")
    )


def _sets(docs: DataFrame, ids: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """(rep, items): the full sets of the representatives in ``ids`` (column rep)."""
    wanted = saved(reps.join(ids.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "d1", "d2"), "wanted")
    ends = small(saved(wanted.select("doc_id").distinct(), "ends"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(low, SLICE_ROWS)
                items = [shingles(t.as_py(), s.words) for t in part.column(1)]
                both = [digests(x) for x in items]
                d1, d2 = (pa.array([x[k] for x in both], pa.int64()) for k in (0, 1))
                yield pa.record_batch([part.column(0), d1, d2, pa.array([x.view(np.int64) for x in items], pa.list_(pa.int64()))], ["doc_id", "d1", "d2", "items"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(ends, "doc_id", "left_semi")
    full = texts.mapInArrow(sets, "doc_id long, d1 long, d2 long, items array<long>").join(small(wanted), ["doc_id", "d1", "d2"])
    return saved(full.groupBy("rep").agg(F.max("items").alias("items")), "sets")  # of rows that are repeated


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """(a, b, linked): the exact answer for each pair, from full sets."""

    full = _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("rep")), reps, s)
    both = F.size(F.array_intersect("items_a", "items_b"))
    return (
        pairs.join(full.select(F.col("rep").alias("a"), F.col("items").alias("items_a")), "a")
        .join(full.select(F.col("rep").alias("b"), F.col("items").alias("items_b")), "b")
        .select("a", "b", (100 * both >= s.percent * (F.size("items_a") + F.size("items_b") - both)).alias("linked"))
    )


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Common items of every two sets, exact, by products of 0/1 matrices."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, item, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1  # an item of one set is common to none
    place = np.cumsum(several) - 1
    rows, item = rows[several[item]], place[item[several[item]]]
    order = np.argsort(item, kind="stable")
    rows, item = rows[order], item[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    width = 4096
    for low in range(0, int(several.sum()), width):
        at = slice(*np.searchsorted(item, [low, low + width]))
        x = np.zeros((len(sets), width), dtype=np.float32)  # counts up to 4096 are exact
        x[rows[at], item[at] - low] = 1
        out += (x @ x.T).astype(np.int64)
    np.fill_diagonal(out, [len(x) for x in sets])
    return out


def _crowds(crowded: DataFrame) -> DataFrame:
    """(rep, crowd): nodes (node, rep, first) that share members are one crowd."""
    found = connected_components(crowded.select(F.col("first").alias("a"), F.col("rep").alias("b")))
    return found.select(F.col("id").alias("rep"), F.col("component").alias("crowd"))


def _compared_whole(crowds: DataFrame, reps: DataFrame, most: int) -> DataFrame:
    """``crowds`` (rep, crowd) with ``whole``: whether the crowd has at most ``most`` blocks."""
    blocks = F.greatest(F.count(F.lit(1)) / CROWD_BLOCK, F.sum("n") / CROWD_ITEMS)
    sizes = crowds.join(reps.select("rep", "n"), "rep").groupBy("crowd").agg((blocks <= most).alias("whole"))
    return crowds.join(small(saved(sizes, "crowd-sizes")), "crowd").select("rep", "crowd", "whole")


def _links_of_crowds(members: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """(a, b) that connect what is linked among the ``members`` (rep, crowd, c) of crowds.

    Each member outside the largest component of its crowd meets all others,
    block by block; a pair of blocks gives the edges of a spanning forest.
    """
    members = saved(members, "crowds")
    main = members.groupBy("crowd", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("crowd").agg(F.max_by("c", F.struct("n", "c")).alias("main"))
    dealt = members.join(small(saved(main, "crowd-mains")), "crowd").withColumn("rest", F.col("c") != F.col("main")).join(sets, "rep")
    weight = F.greatest(F.count(F.lit(1)) / CROWD_BLOCK, F.sum(F.size("items")) / CROWD_ITEMS)
    parts = dealt.groupBy("crowd", "rest").agg(F.ceil(weight).cast("int").alias("blocks"))
    blocks = parts.groupBy("crowd").agg(
        F.coalesce(F.max(F.when(F.col("rest"), F.col("blocks"))), F.lit(0)).alias("n_rest"),
        F.coalesce(F.max(F.when(~F.col("rest"), F.col("blocks"))), F.lit(0)).alias("n_main"),
    )
    # blocks of the rest are numbered first; each of them meets all blocks, itself too
    block = F.when(F.col("rest"), F.pmod(F.xxhash64("rep"), "n_rest")).otherwise(F.col("n_rest") + F.pmod(F.xxhash64("rep"), "n_main")).cast("int")
    last = F.when(F.col("rest"), F.col("n_rest") + F.col("n_main")).otherwise(F.col("n_rest")) - 1
    met = (
        dealt.join(small(saved(blocks.where("n_rest > 0"), "crowd-blocks")), "crowd")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select("crowd", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "items")
    )

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        rep, n = f["rep"].to_numpy(), f["items"].map(len).to_numpy()
        both = shared_counts([np.asarray(x, dtype=np.int64) for x in f["items"]])
        near = 100 * both >= s.percent * (n[:, None] + n[None, :] - both)
        seen, edges = np.zeros(len(rep), dtype=bool), []
        for start in range(len(rep)):
            waiting = [] if seen[start] else [start]
            seen[start] = True
            while waiting:
                at = waiting.pop()
                for to in np.flatnonzero(near[at] & ~seen).tolist():
                    seen[to] = True
                    waiting.append(to)
                    edges.append((min(rep[at], rep[to]), max(rep[at], rep[to])))
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return met.groupBy("crowd", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _join(reps: DataFrame, docs: DataFrame, s: Settings) -> DataFrame | None:
    """(id, component) of the linked representatives; None if nothing is linked."""
    components, tested = None, None

    def with_component(df: DataFrame, name: str) -> DataFrame:
        if components is None:
            return df.withColumn(f"c_{name}", F.col(name))
        c = components.select(F.col("id").alias(name), F.col("component").alias(f"c_{name}"))
        return df.join(c, name, "left").withColumn(f"c_{name}", F.coalesce(f"c_{name}", name))

    def test(pairs: DataFrame) -> None:
        """Confirm candidates whose ends are not connected yet, and connect."""
        pairs = with_component(with_component(pairs.select("a", "b"), "a"), "b").where("c_a <> c_b").select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = saved(pairs, "candidates")
        if pairs.isEmpty():
            return
        connect(saved(_linked(pairs, docs, reps, s), "tested"))

    def connect(new: DataFrame) -> None:
        nonlocal components, tested
        tested = new if tested is None else tested.unionByName(new)
        if not new.where("linked").isEmpty():
            components = connected_components(tested.where("linked"))

    sets, larger = None, None
    for depth in s.depths:
        if larger is None:
            level = nodes(reps, s.trees, depth)
        else:  # fresh trees: what met in a crowded node meets again but for MISS
            sets = sets or _sets(docs, larger, reps, s)
            tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # long work on few rows: not merged by their bytes
            deep = own_nodes(sets.join(small(larger), "rep", "left_semi").repartition(tasks, "rep"), trees_at(s, depth), depth)
            level = saved(deep, "deep")  # read twice below, branched once
        firsts = level.groupBy("node").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first < last")
        level = saved(level.select("node", "rep").join(firsts.select("node", "first"), "node"), "nodes")

        # of the smallest members of its nodes, each document first meets the one it shares the most nodes with,
        # so large groups are connected before anything is compared widely
        if larger is None:
            shared = level.where("rep <> first").groupBy("rep", "first").agg(F.count(F.lit(1)).alias("n"))
            best = shared.groupBy("rep").agg(F.max_by("first", F.struct("n", -F.col("first"))).alias("first"))
            test(_similar(best.select(F.col("first").alias("a"), F.col("rep").alias("b")), reps, s))

        apart = with_component(with_component(level, "rep"), "first").select("node", "rep", "first", F.col("c_rep").alias("c"), F.col("c_first").alias("c_of_first"))
        parts = apart.groupBy("node", "c").agg(F.count(F.lit(1)).alias("n"))
        # the members outside the largest component of their node; none: the node is done
        rest = parts.groupBy("node").agg(F.max(F.struct("n", "c"))["c"].alias("main"), (F.sum("n") - F.max("n")).alias("rest"), F.sum("n").alias("members")).where("rest > 0")
        apart = saved(apart.join(rest, "node"), "apart")
        light = (F.col("rest") <= s.small) & (F.col("rest") * F.col("members") <= s.pairs)
        crowded = apart.where(~light)
        larger = saved(crowded.select("rep").distinct(), "larger")
        last, done = depth == s.depths[-1], larger.isEmpty()
        crowds = larger.withColumn("crowd", F.col("rep")) if done else saved(_crowds(crowded), "crowd-ids")
        # each of the rest against all members of other components, but for pairs that a crowd, or its deeper trees, compares anyway
        few = apart.where(light).join(small(crowds), "rep", "left")
        other = few.select("node", F.col("rep").alias("b"), F.col("c").alias("c_b"), F.col("crowd").alias("crowd_b"))
        apart_yet = (F.col("m.c") != F.col("o.c_b")) & (F.col("m.crowd").isNull() | F.col("o.crowd_b").isNull() | (F.col("m.crowd") != F.col("o.crowd_b")))
        met = few.where("c <> main").alias("m").join(other.alias("o"), (F.col("m.node") == F.col("o.node")) & apart_yet)
        pairs = met.select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()
        test(_similar(pairs, reps, s))
        if done:
            return components

        # nothing is left out at the last depth: crowds of any size are compared
        crowds = crowds.withColumn("whole", F.lit(True)) if last else saved(_compared_whole(crowds, reps, s.whole), "crowds-sized")
        if not crowds.where("whole").isEmpty():
            sets = sets or _sets(docs, larger, reps, s)
            members = with_component(crowds.where("whole"), "rep").select("rep", "crowd", F.col("c_rep").alias("c"))
            connect(saved(_links_of_crowds(members, sets, s).withColumn("linked", F.lit(True)), "crowd-links"))
        larger = crowds.where("NOT whole").select("rep")
        if larger.isEmpty():
            return components


def near_duplicates_by_text(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of :func:`near_duplicates` with ``digest``, the xxhash64 of their text."""
    s = settings or Settings(whole=CROWD_BLOCKS)
    every = saved(sketches(docs, s.words), "sketches")
    groups = (
        every.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    )
    groups = saved(groups, "groups")
    # a representative is a (doc_id, set): named by its doc_id, or, where several sets have that, by a hash of both for all but one
    key = F.struct("d1", "d2", "n_shingles")
    repeated = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sets"), F.min(key).alias("one")).where("sets > 1").select("doc_id", "one")
    named = groups.join(small(saved(repeated, "repeated")), "doc_id", "left")
    rep = F.when(F.col("one").isNull() | (F.col("one") == key), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "d1", "d2", "n_shingles"))
    reps = saved(named.select(rep.alias("rep"), "doc_id", "d1", "d2", F.col("n_shingles").alias("n"), "sig"), "reps")
    linked = _join(reps.select("rep", "doc_id", "d1", "d2", "n", "sig"), docs, s)
    same = reps.select("d1", "d2", F.col("n").alias("n_shingles"), "rep", F.col("doc_id").alias("first_id"))
    if linked is not None:
        ids = reps.select(F.col("rep").alias("id"), "doc_id").join(linked, "id")
        lowest = ids.groupBy("component").agg(F.min("doc_id").alias("lowest"))
        linked = linked.join(lowest, "component").select(F.col("id").alias("rep"), "lowest")
        same = same.join(linked, "rep", "left").withColumn("first_id", F.coalesce("lowest", "first_id"))
    same = same.select("d1", "d2", "n_shingles", "first_id")
    out = every.select("doc_id", "digest", "n_shingles", "d1", "d2").join(same, ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_id", "doc_id"))
    return out.select(
        "doc_id", "digest", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Documents are linked if their shingle sets have a similarity of at least
    ``percent``; ``component_id`` is the smallest doc_id reachable, ``kept``
    marks it. Null texts and texts without words have an empty set, are linked
    with nothing and kept. Rows with a null doc_id are linked with nothing,
    have no component and are kept. Rows that repeat a doc_id are judged by
    their texts: each has the copies and near copies of its own. Other columns
    are not read. No documents: no rows.
    """
    return near_duplicates_by_text(docs, settings).drop("digest")
