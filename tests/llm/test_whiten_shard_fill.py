"""Whitening, sharding and fill-in-middle against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import comb

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from overspend.llm import catalog, fill_middle, sharding, whitening
from pyspark.sql import functions as F

# --- whitening --------------------------------------------------------------------


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, x string, copies int, z double")


def plain_whitening(rows, weights="counts", k=8):
    """id -> list of (deviation, [whitened]) for the usable rows, and explained shares."""
    ok = [(i, [int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) and abs(c) < 2**42 for c in v)]
    lengths = Counter(len(v) for _, v in ok)
    d = max(lengths, key=lambda n: (lengths[n], n))
    ok = [(i, v) for i, v in ok if len(v) == d]
    fit = [v for _, v in ok] if weights == "counts" else [list(v) for v in {tuple(v) for _, v in ok}]
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array([[(n * a - b) / n for a, b in zip(v, s, strict=True)] for v in fit])
    cov = x.T @ x / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = defaultdict(list)
    for i, v in ok:
        y = np.array([(n * a - b) / n for a, b in zip(v, s, strict=True)])
        out[i].append((n, sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)), (y @ u) / np.sqrt(np.maximum(e, 1e-300))))
    return out, e / np.trace(cov)


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_equals_plain_version(spark, weights, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 300)
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(12, 12)) * 0.3
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=12) @ mix]) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]  # a third are copies of one
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, rows[3][1]), (None, [0.25] * 12), (2000, [1e4] * 12)]
    odd = [(3000, None), (3001, []), (3002, [1.0, None] * 6), (3003, [float("nan")] * 12), (3004, [float("-inf")] * 12), (3005, [1e30] * 12), (3006, [0.5] * 11)]
    want, shares = plain_whitening(rows + odd, weights)
    got = whitening.whiten(vectors_of(spark, rows + odd), weights=weights).collect()
    assert Counter(r["vec_id"] for r in got) == Counter({i: 8 * len(v) for i, v in want.items()})
    signs = {}
    for r in got:
        c = r["component"] - 1
        near = [w for w in want[r["vec_id"]] if w[1] == int(r["deviation"])]
        assert near and near[0][0] == r["n"]
        options = [w[2][c] for w in near]
        sign = signs.setdefault(c, next((float(np.sign(o * r["whitened"])) for o in options if abs(o) > 1e-3), 1.0))
        assert any(abs(o * sign - r["whitened"]) < 1e-7 for o in options)
        assert r["explained"] == pytest.approx(shares[c], rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_of_few_and_none(spark):
    assert whitening.whiten(vectors_of(spark, [])).collect() == []
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, []), (3, [None])])).collect() == []
    same = whitening.whiten(vectors_of(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [0.5])])).collect()  # nothing varies
    assert Counter((r["vec_id"], r["component"], r["whitened"], int(r["deviation"]), r["n"]) for r in same) == Counter((i, c, None, 0, 2) for i in (1, 2) for c in (1, 2))
    line = whitening.whiten(vectors_of(spark, [(k, [float(k), 2.0 * k, 7.0]) for k in range(4)])).collect()  # one direction varies
    assert all((r["whitened"] is not None) == (r["component"] == 1) and r["identity_error"] < 1e-9 for r in line) and len(line) == 12
    with pytest.raises(ValueError):
        whitening.whiten(vectors_of(spark, []), weights="none")


def test_deviations_are_exact():
    rng = np.random.default_rng(1)
    for size, n in ((2000, 50), (2**40, 10**9), (10, 10**14), (2**50, 3)):
        x = rng.integers(-size, size, (20, 6))
        sums = [int(v) * 7 + 3 for v in rng.integers(-size, size, 6)]
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
        assert [v if v < 10**38 else None for v in want] == [v if v is None else int(v) for v in whitening._deviations(x, n, sums)]


# --- sharding ----------------------------------------------------------------------


@pytest.mark.parametrize("total,marked,drawn", [(20, 7, 9), (20, 20, 5), (20, 0, 5), (20, 5, 20), (9, 8, 7), (400, 130, 77), (1, 1, 0), (0, 0, 0), (5000, 312, 2500)])
def test_hypergeometric_inverse(spark, total, marked, drawn):
    """Evenly spread u give every count as often as its probability says."""
    grid = 2000
    long = lambda v: F.lit(v).cast("long")
    draws = spark.range(grid).select(sharding.hypergeometric(long(total), long(marked), long(drawn), (F.col("id") + 0.5) / grid).alias("k"))
    got = {r["k"]: r["count"] for r in draws.groupBy("k").count().collect()}
    low, high = max(0, drawn - (total - marked)), min(drawn, marked)
    share = {k: comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn) for k in range(low, high + 1)}
    assert set(got) <= set(share) and sum(got.values()) == grid
    assert all(abs(got.get(k, 0) - p * grid) <= 2 for k, p in share.items())


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_matrix_adds_up(spark, shards):
    parts = {0: 10, 1: 3, 4: 1, 5: 777, 9: 40, 12: 2}
    got = sharding.communication_matrix(spark.createDataFrame(list(parts.items()), "part long, n long"), shards).collect()
    assert {r["part"]: sum(r["counts"]) for r in got} == parts
    columns = [sum(c) for c in zip(*(r["counts"] for r in got), strict=True)]
    assert min(min(r["counts"]) for r in got) >= 0 and max(columns) - min(columns) <= 1 and len(columns) == shards
    assert sharding.communication_matrix(spark.createDataFrame([], "part long, n long"), shards).collect() == []


def test_halves_are_drawn_from_their_distribution(spark):
    """Over many nodes, each split of three shards has its multivariate hypergeometric share."""
    nodes, sizes, left = 20_000, (4, 3, 5), 5
    counts = F.array(*[F.lit(v).cast("long") for v in sizes])
    split = sharding._left_counts(counts, F.lit(sum(sizes)).cast("long"), F.lit(left).cast("long"), 1, 0, F.col("id"))
    got = {tuple(r["c"]): r["count"] for r in spark.range(nodes).groupBy(split.alias("c")).count().collect()}
    share = {
        (a, b, left - a - b): comb(4, a) * comb(3, b) * comb(5, left - a - b) / comb(12, left)
        for a in range(5) for b in range(4) if 0 <= left - a - b <= 5
    }
    assert set(got) <= set(share) and sum(got.values()) == nodes
    assert all(abs(got.get(k, 0) - nodes * p) < 5 * (nodes * p * (1 - p)) ** 0.5 + 1 for k, p in share.items())


def test_shards_hold_every_row_once(spark, docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 16)
    rows = odd_rows + [(k, f"text {k}") for k in range(700)] + [(900, "same text")] * 300
    docs = docs_of(rows).withColumn("__place", F.lit("kept")).withColumn("slot", F.lit(-1)).repartition(9)
    out = sharding.shuffle_into_shards(docs, 16)
    assert out.columns == [c for c in docs.columns if c != "slot"] + ["shard", "slot"]
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows) and {r["__place"] for r in got} == {"kept"}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(16)]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and max(sizes) - min(sizes) <= 1
    few = sharding.shuffle_into_shards(docs_of([(1, "a"), (2, None), (3, "")]), 16).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shuffle_into_shards(docs_of([]), 16).collect() == []
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(docs, 0)


def test_shuffle_is_uniform_and_repeatable(spark):
    n, shards = 16_000, 8
    rows = spark.range(0, n, 1, 5)
    first = {r["id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(rows, shards).collect()}
    assert first == {r["id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(rows, shards).collect()}
    other = {r["id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(rows, shards, seed=2).collect()}
    expected = n / 10 / shards
    for k in range(10):  # each tenth of the input spreads evenly over shards and over slots
        part = [first[i] for i in range(k * n // 10, (k + 1) * n // 10)]
        by_shard, by_slot = Counter(s for s, _ in part), Counter(x * shards // (n // shards) for _, x in part)
        assert all(abs(by_shard[s] - expected) < 5 * expected**0.5 and abs(by_slot[s] - expected) < 5 * expected**0.5 for s in range(shards))
    together = sum(first[i][0] == first[i + 1][0] for i in range(n - 1))
    assert abs(together - n / shards) < 5 * (n / shards) ** 0.5
    assert abs(sum(first[i][0] == other[i][0] for i in range(n)) - n / shards) < 5 * (n / shards) ** 0.5


def test_written_shards(spark, tmp_path):
    sharding.write_shards(spark.range(0, 1000, 1, 4), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000 and {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == dict.fromkeys(range(4), 250)
    assert sorted(r["slot"] for r in back.where("shard = 3").collect()) == list(range(250))


# --- fill-in-middle ---------------------------------------------------------------------


def plain_fill(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fill_rows(odd_rows):
    rnd = random.Random(9)
    letters = "abZ é日😀̈-<>PSM\n\r\t0"
    rows = [(k, "".join(rnd.choice(letters) for _ in range(rnd.randrange(60)))) for k in range(300)]
    return rows + odd_rows + [(500, "a <P> b"), (501, "<S"), (502, "x<M>"), (503, "<P"), (504, "é" * 5000), (505, "😀"), (506, "Z" * 70_000), (507, ">S<" * 40)]


def test_fill_middle_equals_plain_version(docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 1000)
    rows = fill_rows(odd_rows)
    out = fill_middle.restore(fill_middle.to_fill_middle(docs_of(rows))).collect()
    got = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out)
    assert got == Counter(plain_fill(i, t) for i, t in rows)
    assert Counter((r["doc_id"], r["restored"]) for r in out) == Counter((i, t or "") for i, t in rows)
    assert {"plain", "psm", "spm"} == {r["form"] for r in out}
    for r in out:
        if r["form"] == "psm":  # spans in bytes and in code points name the same text
            data, start = r["output"].encode(), len("<P>")
            assert data[start : start + r["prefix_bytes"]].decode() == r["output"][start : start + r["prefix_chars"]]
            assert len(data) - r["middle_bytes"] == len(data.rpartition(b"<M>")[0]) + 3 or "<M>" in r["restored"]


def test_fill_middle_of_nothing(docs_of):
    assert fill_middle.to_fill_middle(docs_of([])).collect() == []


def test_exception_index_converts_both_ways():
    for text in ("", "plain", "é", "a日b😀c", "日本語", "x" * 50 + "é" + "y" * 50):
        index = fill_middle.ExceptionIndex.of(np.frombuffer(text.encode(), dtype=np.uint8))
        chars = np.arange(len(text) + 1)
        places = np.array([len(text[:c].encode()) for c in chars])
        assert index.to_bytes(chars).tolist() == places.tolist() and index.to_chars(places).tolist() == chars.tolist()
        assert len(index.byte) == sum(ord(c) > 127 for c in text)


def test_fill_middle_sql(docs_of, odd_rows, spark, tmp_path, monkeypatch):
    """The registered query and its SQL agree on the crafted rows too."""
    rows = fill_rows(odd_rows)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.op13_fill_middle(spark, str(tmp_path))
    documents = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())})  # noqa: F841 — read by DuckDB
    want = duckdb.sql(catalog.ORACLE["op13_fill_middle"])
    assert got.columns == want.columns
    assert Counter(tuple(r) for r in got.collect()) == Counter(want.fetchall())
