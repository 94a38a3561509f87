"""Vectors, conversations and the pipeline."""

from __future__ import annotations

import random
import sys
from collections import Counter

import brute
import numpy as np
import pytest
from llm_rows import SF
from overspend.llm import chat_quotes, packing, quality, vector_search
from overspend.llm.catalog import tokenizer_path
from pyspark.sql import functions as F


# --- vectors -----------------------------------------------------------------

def brute_top_k(rows, k, scale):
    ok = [(i, np.floor(scale * np.array(v, dtype=float))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = list({(i, tuple(v)): (i, v) for i, v in ok}.values())
    width = max((len(v) for _, v in ok), default=0)
    ok = [(i, np.pad(v, (0, width - len(v)))) for i, v in ok]
    out = []
    for q, v in ok:
        if q % 20 == 0:
            best = sorted((-int(v @ w), i) for i, w in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return Counter(out)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, pivot string, c double")


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 40)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = [(k, [float(np.float32(x)) for x in centres[k % 6] + 0.2 * rng.normal(size=8)]) for k in range(700)]
    same = rows[5][1]
    rows += [(1000 + k, same) for k in range(150)]  # many equal vectors: ties by id
    rows += [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (2080, []), (2100, [0.5]), (None, same), (1000, same)]
    got = vector_search.top_k(vectors_of(spark, rows), F.col("vec_id") % 20 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute_top_k(rows, 20, 64)


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, -1.0]), (2, [1000.0, 3.0])]
    got = vector_search.top_k(vectors_of(spark, rows), F.col("vec_id") % 20 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute_top_k(rows, 20, 64)
    big = [(0, [1e6, 2.0]), (1, [1e6, -1.0]), (2, [-1e6, 3.0])]
    got = vector_search.top_k(vectors_of(spark, big), F.col("vec_id") % 20 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute_top_k(big, 20, 64)
    assert vector_search.top_k(vectors_of(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert vector_search.top_k(vectors_of(spark, [(1, None)]), F.col("vec_id") % 20 == 0).count() == 0
    assert vector_search.top_k(vectors_of(spark, [(1, [1.0]), (2, [2.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_query_blocks_have_one_order():
    f = vector_search.pd.DataFrame({"vec_id": [3, 1, 3, 2], "key": [5, 9, 4, 7], "c": [[0.1], [0.2], [0.3], [0.4]]})
    want = vector_search.in_order(f)
    assert want["c"].tolist() == [[0.2], [0.4], [0.3], [0.1]]
    assert all(vector_search.in_order(f.sample(frac=1, random_state=k)).equals(want) for k in range(9))


# --- chats ----------------------------------------------------------------------

def test_quotes_link_replies(spark):
    rows = [
        (1, 0, "user", "How do I sort a table?\nIt has two keys."),
        (1, 1, "assistant", "> how do  I sort a table?\nUse orderBy."),
        (1, 2, "user", "> It has two keys.\nBoth matter."),
        (1, 3, "user", ">> How do I sort a table?\n> Use orderBy.\n\nThanks!"),
        (1, 4, None, "> Thanks!\n> Both matter.\n> Use orderBy.\n> Thanks!\nYou are welcome."),
        (1, 5, "user", "> nobody said this\nNew matter."),
        (2, 0, "user", "How do I sort a table?"),
        (2, 1, "user", "How do I sort a table?"),
        (2, 2, "assistant", "> How do I sort a table?\nagain"),
        (3, 0, "user", "> self\nself"),
        (None, 0, "user", "> Use orderBy.\nx"),
        (1, None, "user", None),
        (4, 0, "user", ""),
    ]
    m = spark.createDataFrame([(*r, "z", 7) for r in rows], "conv_id long, turn long, role string, text string, depth string, votes int")
    out = chat_quotes.format_chats(m)
    got = {(r["conv_id"], r["turn"]): r for r in out.collect()}
    assert len(got) == len(rows)
    parents = {k: r["parent_turn"] for k, r in got.items() if r["parent_turn"] is not None}
    assert parents == {(1, 1): 0, (1, 2): 0, (1, 3): 1, (1, 4): 3, (2, 2): 1}
    assert [(got[1, k]["root_turn"], got[1, k]["depth"]) for k in range(6)] == [(0, 0), (0, 1), (0, 1), (0, 2), (0, 3), (5, 0)]
    assert got[1, 3]["text"] == "Thanks!" and got[1, 3]["n_quoted"] == 2 and got[1, 4]["votes"] == 2
    assert got[1, 4]["formatted"] == "<|user|>\nYou are welcome.\n" and got[3, 0]["text"] == "self" and got[1, None]["text"] == ""
    chat = {r["conv_id"]: r["chat"] for r in chat_quotes.render(out.where("turn IS NOT NULL")).collect()}
    assert chat[2] == "<|user|>\nHow do I sort a table?\n" * 2 + "<|assistant|>\nagain\n"
    assert chat_quotes.format_chats(m.limit(0)).count() == 0


def test_long_reply_chain_and_repeats(spark):
    rows = [(1, k, "user", f"> line {k - 1} of the chain\nline {k} of the chain") for k in range(40)]
    rows += [rows[5], rows[5]]
    got = chat_quotes.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert Counter((r["turn"], r["root_turn"], r["depth"]) for r in got) == Counter((t, 0, t) for _, t, _, _ in rows)


def test_whole_passages_outvote_lines(spark):
    long = "A long line that only the first message of this conversation has."
    rows = [
        (1, 0, f"Thanks.\nYes.\n{long}\nMore of it."),
        (1, 1, "Thanks.\nYes.\nOther words."),
        (1, 2, f"> Thanks.\n> Yes.\n> {long}\n> More of it.\nthe whole"),
        (2, 0, f"Thanks.\n{long}"),
        (2, 1, "Thanks.\nOther words."),
        (2, 2, f"> Thanks.\n> {long}\nits tie"),
        (3, 0, f"{long} And it goes on.\n\nA second paragraph."),
        (3, 1, "> A long line that only the first message\n> of this conversation has. And it\n> goes on.\nwrapped"),
        (3, 2, ">> A second paragraph.\n> words that nobody wrote\ndeeper"),
        (4, 0, f"Thanks.\n{long}\nMore."),
        (4, 1, "Thanks.\nOther words."),
        (4, 2, f"> Thanks.\n> {long}\npart of a passage"),
    ]
    m = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["votes"]) for r in chat_quotes.parents(m).collect()}
    assert got == {(1, 2): (0, 4), (2, 2): (0, 2), (3, 1): (0, 3), (3, 2): (0, 1), (4, 2): (0, 2)}


# --- the pipeline ------------------------------------------------------------------

@pytest.fixture(scope="module")
def pipeline():
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline

    return corpus_pipeline


def test_pipeline_matches_brute_force(spark, pipeline):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs.where(~quality.held_out(F.col("doc_id"))), labels)
    scores = {r["doc_id"]: r["score"] for r in quality.with_score(docs, model).select("doc_id", "score").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if scores[r["doc_id"]] >= 0.7]
    rows = [(d, kept if n else t) for (d, t), (_, n, kept) in zip(rows, brute.dedup_lines(rows))]
    linked = brute.components(rows)
    rows = [(d, t) for d, t in rows if linked[d][1] == d]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not brute.contamination(t, items)[3]]
    tokenizer, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for d, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want.update((d, at, n, ids[at : at + n].tobytes()) for at, n in packing.pieces(len(ids), 2048))
    got = Counter((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in pipeline.run(spark, SF).collect())
    assert got == want and len(rows) < docs.count()


def test_stages_with_odd_rows(spark, pipeline, odd_rows):
    rng = random.Random(2)
    rows = [*odd_rows, *((k, " ".join(rng.choice(["one", "two", "three", "four", "Five."]) for _ in range(60))) for k in range(30))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, drop int, __n_lines int"
    docs = spark.createDataFrame([(d, t, "en", "s", 0, 0.1, "d", 4, 5) for d, t in rows], schema)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() <= len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    ids = [r["doc_id"] for r in pipeline.near_dedup_stage(spark, docs, SF).collect()]
    assert ids.count(None) == 2 and 100_005 not in ids and 100_004 in ids
    assert pipeline.packing_stage(spark, docs, SF).select("doc_id").distinct().count() == len({d for d, _ in rows})


def test_rows_of_one_id_go_by_their_texts(spark, pipeline):
    words = [f"w{k}" for k in range(60)]
    a, b, c = " ".join(words), " ".join(f"x{k}" for k in range(40)), " ".join(f"y{k}" for k in range(20))
    near_b, near_c = b + " end", c + " end"
    rows = [(1, a), (3, a), (3, b), (5, near_b), (3, c), (2, near_c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = Counter(tuple(r) for r in pipeline.near_dedup_stage(spark, docs, SF).collect())
    assert out == Counter([(1, a), (3, b), (2, near_c)])
