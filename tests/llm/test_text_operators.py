from __future__ import annotations

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from llm_rows import SF
from overspend.llm import catalog, decontamination, licenses, line_dedup, near_dedup, packing, quality, substring_dedup, url_filter
from overspend.llm.components import connected_components
from overspend.llm.suffix_array import suffix_array
from pyspark.sql import functions as F


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# --- URL filters -----------------------------------------------------------

URLS = [
    "https://example.org/es/x", "http://a.b.EXAMPLE.org/en/12?q#f", "https://example.org/en/", "http://notexample.org/es/", "https://org",
    "https://org/", "ftp://x.com/de/1", "http://com/fr/", "http://x.com?u=http://y.org/", "no scheme", "", None, "://", "http:///path",
    "http://user@example.org:80/es/", "http://x.com/fr", "http://é.ORG/ü/", "http://a..org/x", "http://x.net/" + "p" * 5000,
    "http://" + "s." * 300 + "example.org/es/1", "http://x.com/de/#\nq",
]


def test_urls_match_brute_force(spark):
    rules = [*catalog.URL_RULES, ("net", "/", "block"), ("x.net", "", "allow"), ("Example.ORG", "/es/x", "allow"), ("org", "/", "allow")]
    rows = [(k, u, "h") for k, u in enumerate(URLS)] + [(None, URLS[0], "h"), (0, URLS[0], "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    lowered = [(h.lower(), p, v) for h, p, v in rules]
    want = Counter((k, *brute.judge_url(u, lowered)) for k, u, _ in rows)
    assert rows_of(url_filter.filter_urls(pages, url_filter.rule_table(spark, rules))) == want


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    bad = url_filter.rule_table(spark, [("", "/", "block"), (None, "/", "block"), ("org", None, "block"), ("org", "/", "else")])
    assert [r["verdict"] for r in url_filter.filter_urls(pages, bad, default="block").collect()] == ["block"]
    rules = url_filter.rule_table(spark, catalog.URL_RULES)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    # of equal rules block wins, then the longer host
    tie = url_filter.rule_table(spark, [("example.org", "/e", "allow"), ("example.org", "/e", "block")])
    assert url_filter.filter_urls(pages, tie).first()["verdict"] == "block"


# --- suffix arrays and repeated strings ---------------------------------------

def test_suffix_array_matches_sorting():
    rng = random.Random(3)
    for _ in range(600):
        s = bytes(rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 60)))
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    long = b"ab" * 500 + b"a" * 500
    assert suffix_array(long) == sorted(range(len(long)), key=lambda i: long[i:])


@pytest.mark.parametrize("group,least_hot", [(4096, 128), (1, 10**9), (4096, 2)])
def test_repeats_match_brute_force(docs_of, sample, odd_rows, group, least_hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", group)  # 1: every mixed group takes the way of very large ones
    monkeypatch.setattr(substring_dedup, "LEAST_HOT", least_hot)
    monkeypatch.setattr(substring_dedup, "SAMPLE_EVERY", 2)
    run = "".join(random.Random(5).choice("abcdefgh ") for _ in range(400))
    rows = sample[:60] + [r for r in odd_rows if len(r[1] or "") < 10_000]
    rows += [(200_000 + k, run[k : k + 150] + str(k) * k + run) for k in range(40)]  # many copies with different ends
    rows += [(300_000, "z" * 1000), (300_001, "z" * 99), (300_002, "é" * 60 + "x"), (300_003, "xy" * 300)]
    got = rows_of(substring_dedup.remove_repeats(docs_of(rows)))
    assert got == Counter((d, *r) for (d, _), r in zip(rows, brute.remove_repeats(rows, 100)))


def test_repeats_of_other_lengths_and_empty(docs_of):
    rows = [(k, "".join(random.Random(k % 3).choice("ab") for _ in range(50))) for k in range(9)]
    got = rows_of(substring_dedup.remove_repeats(docs_of(rows), length=12, anchor=8))
    assert got == Counter((d, *r) for (d, _), r in zip(rows, brute.remove_repeats(rows, 12)))
    assert substring_dedup.remove_repeats(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(docs_of([]), length=20)


# --- packing ------------------------------------------------------------------

def test_packing_round_trip(docs_of, sample, odd_rows):
    from tokenizers import Tokenizer

    path = catalog.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    rows = sample[:80] + odd_rows
    packed = packing.pack(docs_of(rows), path).collect()
    assert len({r["sequence_id"] for r in packed}) == len(packed)
    want = Counter()
    for d, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID], dtype="<u4")
        for at, n in packing.pieces(len(ids), 2048):
            want[d, at, n, len(ids), zlib.crc32(ids[at : at + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"], zlib.crc32(r["ids"])) for r in packed) == want
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 for r in packed)


def test_pieces():
    for n in range(1, 300):
        cut = packing.pieces(n, 64)
        assert [at for at, _ in cut] == [sum(s for _, s in cut[:k]) for k in range(len(cut))]
        assert sum(s for _, s in cut) == n and all(s & (s - 1) == 0 and s <= 64 for _, s in cut)


def test_packing_of_nothing(docs_of):
    assert packing.pack(docs_of([]), catalog.tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs_of([]), catalog.tokenizer_path(), longest=100)


# --- quality ----------------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r["held_out"]} == {d for d in got if zlib.crc32(str(d).encode()) % 4 == 2}
    good, bad = ([got[d]["score"] for d in held if truth[d] == y] for y in (1, 0))
    assert min(good) > 0.7 > max(bad)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_quality_odd_rows(spark, docs_of, sample, odd_rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    more = spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, 1), (3, 1)], "doc_id long, quality int")
    rows = sample + odd_rows
    got = quality.classify(docs_of(rows), labels.unionByName(more)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    by_id = {}
    for r in got:  # equal texts have equal scores
        assert by_id.setdefault(r["doc_id"], r["score"]) == r["score"] or r["doc_id"] is None
    assert by_id[100_001] == by_id[100_002]


def test_quality_without_both_classes(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(k, 1) for k in range(5)], "doc_id long, quality int")
    rows = [(k, f"text {k}") for k in range(5)]
    assert {r["score"] for r in quality.classify(docs_of(rows), none).collect()} == {0.5}
    assert {r["score"] for r in quality.classify(docs_of(rows), one).collect()} == {1.0}
    assert quality.classify(docs_of([]), one).count() == 0


# --- near-dedup -------------------------------------------------------------------

def near_copies(count, seed, words=120, edits=6):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for k in range(count):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(5000)}"
        yield " ".join(w)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 230)] + [(5, 5), (None, 3), (900, 901), (901, 900)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in (7, *range(200, 230))}, 900: 900, 901: 900}


def test_near_duplicates_match_brute_force(docs_of, sample, odd_rows):
    rows = sample + [r for r in odd_rows if r[0] != 100_012]
    rows += [(400_000 + k, t) for k, t in enumerate(near_copies(90, 1))]  # one large group, many pairs below the limit
    rows += [(500_000 + k, t) for k, t in enumerate(near_copies(30, 2, words=40, edits=2))]
    got = near_dedup.near_duplicates(docs_of(rows)).collect()
    want = brute.components(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got if r["doc_id"] is not None)
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)


def test_large_nodes_are_branched_deeper(docs_of):
    rows = [(k, t) for k, t in enumerate(near_copies(120, 4, words=60, edits=9))]
    small = near_dedup.Settings(small=4, depths=(1, 3, 6))  # nodes stay large, so the recursion and its end run
    got = near_dedup.near_duplicates(docs_of(rows), small).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.components(rows)


def test_near_duplicates_odd_input(docs_of):
    same = "one two three four five six seven"
    rows = [(3, same), (1, same.upper()), (1, same.upper()), (2, "a b"), (4, "A\tb"), (5, None), (6, "")]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs_of(rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 2, True), (3, 1, False), (4, 2, False), (5, 5, True), (6, 6, True)]
    assert near_dedup.near_duplicates(docs_of([])).count() == 0


# --- decontamination ----------------------------------------------------------------

def contaminated_rows(items):
    rng = random.Random(9)
    words = ["of", "the", "and", *(f"v{k}" for k in range(50))]
    for k in range(40):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 200)))
        item = items[k % len(items)][1] or ""
        yield 600_000 + k, f"{text} {item.upper()}! {text}" if k % 2 else f"{text} {' '.join(item.split()[: k % 20])}"


def test_decontamination_matches_brute_force(spark, docs_of, sample, odd_rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(7001, "the of"), (7002, "word5 number5"), (7003, None), (7004, " - "), (7005, "the the the the the"), (7006, items[0][1])]
    items += [(items[1][0], items[1][1])]
    rows = sample[:80] + [r for r in odd_rows if r[0] not in (100_004, 100_005)] + list(contaminated_rows(items))
    rows.append((8001, "the " * 30))
    bench = spark.createDataFrame([(*i, "x") for i in [*items, (None, "own words of this document")]], "item_id long, text string, words string")
    got = decontamination.decontaminate(docs_of(rows), bench).collect()
    want = Counter()
    for d, t in rows:
        n, hit, found, bad = brute.contamination(t, items)
        want[d, n, hit, tuple(found), bad] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got) == want
    assert sum(r["contaminated"] for r in got) > 10


def test_decontamination_of_nothing(spark, docs_of):
    empty = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.decontaminate(docs_of([(1, "a b c")]), empty).collect()
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got] == [(3, 0, [], False)]
    assert decontamination.decontaminate(docs_of([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_proximity(spark, docs_of):
    rows = [(1, "alpha x x beta x x x x x x x x x x x x x alpha"), (2, "beta alpha alpha"), (None, "alpha beta")]
    files = decontamination.words_of(docs_of(rows))
    terms = spark.createDataFrame([("alpha",), ("beta",)], "term string")
    index = decontamination.positional_index(files, terms, 2)
    pairs = spark.createDataFrame([("alpha", "beta")], "term string, other string")
    got = Counter((r["doc_id"], r["at"], r["other_at"]) for r in decontamination.proximity_matches(index, pairs, 3).collect())
    assert got == Counter([(1, 0, 3), (2, 1, 0), (2, 2, 0), (None, 0, 1)])


# --- line dedup ------------------------------------------------------------------------

def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63, 5000, dtype=np.int64)
    cuckoo = line_dedup.CuckooFilter.sized(3000)  # too small on purpose: the stash takes the rest
    cuckoo.insert(keys)
    cuckoo = line_dedup.CuckooFilter.load(*cuckoo.dump())
    assert cuckoo.contains(keys).all()
    others = rng.integers(-(2**63), 2**63, 20000, dtype=np.int64)
    roomy = line_dedup.CuckooFilter.sized(6000)
    roomy.insert(keys)
    assert roomy.contains(others).mean() < 0.01
    roomy.delete(keys[:4000])
    assert roomy.contains(keys[4000:]).all() and roomy.contains(keys[:4000]).mean() < 0.01
    cuckoo.delete(keys)
    assert not cuckoo.cells.any() and not cuckoo.stash


def test_line_dedup_matches_brute_force(docs_of, sample, odd_rows):
    line = "A line that is long enough to count."
    rows = sample + odd_rows + [(700_000 + k, f"{line}\n {line.upper()}\t\nown {k} {'x' * k}\n\n{line}") for k in range(30)]
    rows += [(800_000, line), (800_001, f"{line}\r\n"), (800_002, "short"), (800_003, "short"), (800_004, "short")]
    docs = docs_of(rows)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    got = Counter((r["doc_id"], r["__n_lines"], r["__n_dropped"], r["text"] or "") for r in out.collect())
    assert got == Counter((d, *r) for (d, _), r in zip(rows, brute.dedup_lines(rows)))
    assert line_dedup.dedup_lines(docs_of([])).count() == 0


def test_line_index_is_reversible(spark, docs_of, sample, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 5)
    monkeypatch.setattr(line_dedup, "LINES_PER_GROUP", 50)
    first, second = sample[::2], sample[1::2]

    def text(index, rows):
        return Counter((r["doc_id"], r["text"]) for r in index.clean(docs_of(rows)).collect())

    def want(held, rows):
        return Counter((d, k) for (d, t), (_, n, kept) in zip(held, brute.dedup_lines(held)) if (d, t) in rows for k in [kept if n else t])

    old = line_dedup.build(docs_of(first))
    both = old.insert(docs_of(second))
    assert text(both, sample) == want(sample, sample)
    back = both.delete(docs_of(second).select("doc_id"))
    assert text(back, first) == want(first, first) == text(old, first)
    assert rows_of(back.crowded) == rows_of(old.crowded)
    assert both.shards > 1


def hash_of_int(i, seed):
    """Spark's xxhash64 of an int."""
    full = 2**64 - 1
    h = ((seed + 0x27D4EB2F165667C5 + 4) & full) ^ (i * 0x9E3779B185EBCA87 & full)
    h = ((h << 23 | h >> 41) & full) * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9 & full
    h = (h ^ h >> 33) * 0xC2B2AE3D27D4EB4F & full
    h = (h ^ h >> 29) * 0x165667B19E3779F9 & full
    return h ^ h >> 32


def test_second_line_hash_does_not_follow_from_the_first(spark, docs_of):
    line = "a line that is long enough to count"
    assert spark.range(1).select(F.xxhash64(F.lit(7))).first()[0] % 2**64 == hash_of_int(7, 42)
    r = line_dedup._lines(docs_of([(1, line)]), 20).first()
    assert r["k2"] % 2**64 != hash_of_int(len(line), r["k1"] % 2**64)


# --- licences --------------------------------------------------------------------------

def test_base_licenses_match_brute_force(docs_of, sample, odd_rows):
    rows = sample + odd_rows
    rows += [(1, "mit license MIT-License! the apache license, general public license apache license"), (2, "mit licenses general public"), (3, "license mit license")]
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan(docs_of(rows)).collect())
    assert got == Counter((d, *brute.base_licenses(t, licenses.BASE)) for d, t in rows)


def test_notices(docs_of):
    rows = [
        (1, "x Licensed under the Apache License, Version 2.0."),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "the software is licensed under the terms of something"),
        (5, "mit license"),
        (6, "hereby granted, free of charge, to any person obtaining a copy of this software"),
        (7, None),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(rows)).collect()}
    assert [got[k]["labels"] for k in range(1, 8)] == ["apache,apache-2.0", "cc-by-nc", "gpl,gpl-3.0", "", "mit", "mit-grant", ""]
    assert [got[k]["score"] for k in (1, 2, 4, 5, 7)] == [1.0, 1.0, 0.0, 0.5, 0.0]
    assert 0.6 <= got[6]["score"] < 1 and got[1]["notices"][0]["start"] == 1
    assert licenses.scan(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(docs_of([]), notices=(licenses.Template("x", "a b", "c"),))


def test_every_operator_has_one_query():
    names = sorted(catalog.QUERIES)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(catalog.ORACLE) <= set(names)


def test_results_do_not_depend_on_partitions(spark, docs_of, sample):
    rows = sample[:100]
    one = rows_of(near_dedup.near_duplicates(docs_of(rows).coalesce(1)))
    many = rows_of(near_dedup.near_duplicates(docs_of(rows).repartition(7, F.col("doc_id"))))
    assert one == many


def test_links_in_a_crowd_below_the_limit(docs_of):
    """Thousands of documents at a similarity of 0.70, and planted pairs between 0.75 and 0.80."""
    base = " ".join(f"b{k}" for k in range(124))

    def text(k, own):  # 120 shared shingles and 26 others, of which twins share some
        return f"{base} " + " ".join(f"t{k // 2}x{j}" if j < own else f"o{k}x{j}" for j in range(26))

    rows = [(k, text(k, 6 + k // 2 % 4 if k < 120 else 0)) for k in range(2000)]
    assert 0.69 < len(brute.shingles(rows[200][1]) & brute.shingles(rows[201][1])) / len(brute.shingles(rows[200][1]) | brute.shingles(rows[201][1])) < 0.75
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs_of(rows)).collect()}
    assert got == {k: k - k % 2 if k < 120 else k for k in range(2000)}


def test_common_items_of_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, n, dtype=np.uint64)) for n in (1, 40, 5000, 6000, 6001)]
    assert near_dedup.shared_counts(sets).tolist() == [[len(np.intersect1d(x, y)) for y in sets] for x in sets]


def test_line_dedup_keeps_columns_with_clashing_names(spark):
    text = "a line that several documents hold\nown"
    docs = spark.createDataFrame([(k, text, 77, "x", "y", 5) for k in range(3)], "doc_id long, text string, __n_lines int, __drop string, __id string, __digest long")
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "___n_lines", "__n_dropped"]
    assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got.collect()) == [(k, 77, "x", "y", 5, 2, int(k < 2)) for k in range(3)]
