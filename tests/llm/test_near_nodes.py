"""Deep trees of near-dedup: the nodes of a document are its own affair, however many others are like it."""

from __future__ import annotations

import brute
import numpy as np

from overspend.llm import near_dedup as N
from overspend.llm.common import importable

DEPTH = 9


def nodes_of(spark, sets: list[np.ndarray], trees: int) -> dict[int, list[int]]:
    rows = [(k, [int(v) for v in s.view(np.int64)]) for k, s in enumerate(sets)]
    out: dict[int, list[int]] = {}
    for r in N.own_nodes(spark.createDataFrame(rows, "rep long, items array<long>"), trees, DEPTH).collect():
        out.setdefault(r["rep"], []).append(r["node"])
    return {k: sorted(v) for k, v in out.items()}


def test_rows_of_the_deep_trees_grow_with_the_documents_not_with_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 60, dtype=np.uint64)
    group = [np.unique(np.concatenate([base[:50], rng.integers(0, 2**62, 10, dtype=np.uint64)])) for _ in range(200)]
    trees = 3
    small, large = nodes_of(spark, group[:20], trees), nodes_of(spark, group, trees)
    assert len(large) == 200
    assert all(large[k] == nodes for k, nodes in small.items())  # no row more in a group ten times as large
    assert sum(map(len, large.values())) <= 200 * trees * 2**DEPTH
    per_rep = [sum(map(len, found.values())) / len(found) for found in (small, large)]
    assert per_rep[1] < 1.5 * per_rep[0]


def test_deep_trees_are_branched_once_and_name_no_node_twice(spark, monkeypatch):
    importable(spark)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(40):  # unlike enough to stay apart at the first depth
        words = list(base)
        for at in rng.choice(60, 3, replace=False):
            words[at] = f"x{k}y{at}"
        docs.append((k, " ".join(words)))
    made, distinct, plain = spark.sparkContext.accumulator(0), [], N.own_nodes

    def counting(sets, trees, depth):
        level = plain(sets, trees, depth)
        distinct.append((level.count(), level.distinct().count()))

        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return level.mapInArrow(count, level.schema)

    monkeypatch.setattr(N, "own_nodes", counting)
    settings = N.Settings(depths=(2, 4), small=1)
    N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), settings).collect()
    assert len(distinct) == 1  # the second depth was reached
    rows, different = distinct[0]
    assert rows == different > 0
    assert made.value == rows


def family(name: str, members: int, seed: int) -> list[str]:
    """Texts that share 60 words but for some of their own: some are linked, some are not, none with all."""
    rng, out = np.random.default_rng(seed), []
    for k in range(members):
        words = [f"{name}{at}" for at in range(60)]
        for at in rng.choice(60, rng.integers(1, 4), replace=False):
            words[at] = f"{name}{k}y{at}"
        out.append(" ".join(words))
    return out


def branched(monkeypatch) -> list[set[int]]:
    """The representatives that each later call of ``own_nodes`` gets."""
    seen, plain = [], N.own_nodes

    def kept(sets, trees, depth):
        seen.append({r["rep"] for r in sets.select("rep").collect()})
        return plain(sets, trees, depth)

    monkeypatch.setattr(N, "own_nodes", kept)
    return seen


def components_of(spark, rows, settings=None) -> dict:
    importable(spark)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def test_a_crowd_of_few_blocks_is_compared_whole_and_not_branched(spark, monkeypatch):
    seen, compared, plain = branched(monkeypatch), [], N._links_of_crowds
    monkeypatch.setattr(N, "_links_of_crowds", lambda members, *rest: compared.append(members.count()) or plain(members, *rest))
    rows = list(enumerate(family("w", 150, 7)))
    want = brute.components(rows)
    assert 1 < len({c for _, c in want.values()}) < len(rows)
    assert components_of(spark, rows) == want
    assert len(compared) == 1 and compared[0] > 12
    assert not seen


def test_larger_crowds_are_branched_beside_those_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(N, "CROWD_BLOCK", 16)
    seen = branched(monkeypatch)
    rows = [(k, text) for k, text in enumerate([*family("a", 30, 1), *family("b", 120, 2), *family("c", 28, 3)])]
    settings = N.Settings(depths=(2, 4), small=1, pairs=40, whole=2)
    assert components_of(spark, rows, settings) == brute.components(rows)
    assert len(seen) == 1
    assert seen[0] and seen[0] <= set(range(30, 150))
