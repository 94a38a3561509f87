"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_quotes,
    decontamination,
    fill_middle,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    sharding,
    substring_dedup,
    url_filter,
    vector_search,
    whitening,
)
from .common import table

TOKENIZER = "word_bpe_49k.json"
# Fixed values of the URL query: (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.format_chats(table(spark, sf_dir, "conversations"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("notices")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # the exact deviation is a decimal; beyond the range of a long it is null here
    return white.select("vec_id", "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened", "explained", "identity_error")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = sharding.shuffle_into_shards(docs, 16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.to_fill_middle(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_near_dedup": op5_near_dedup,
    "op6_chat_quotes": op6_chat_quotes,
    "op7_vector_search": op7_vector_search,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_whitening": op11_whitening,
    "op12_sharding": op12_sharding,
    "op13_fill_middle": op13_fill_middle,
}

ORACLE = {
    "op1_url_filter": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT row_number() OVER () AS k, page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), ranked AS (
  SELECT k, page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY k ORDER BY length(h || p) DESC, length(h) DESC, v DESC) AS n
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM ranked WHERE n = 1
""",
    "op5_near_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY 1
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sh x JOIN sh y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(id, c) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT b, c FROM reach JOIN edges ON a = id WHERE c < b
), best AS (
  SELECT id, min(c) AS c FROM reach GROUP BY 1
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, c = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN best ON id = d.doc_id
""",
    "op7_vector_search": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_inner_product(q.c, x.c) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
""",
    "op8_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS t
  FROM (SELECT item_id, w[s:s + 12] AS x FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0))
), grams AS (
  SELECT k, s, n, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win))
), hit AS (
  SELECT k, s, g.n, item_id FROM grams g JOIN win USING (n, t)
), places AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM hit) GROUP BY k
), items AS (
  SELECT k, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (k) LEFT JOIN items USING (k)
""",
    "op9_line_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT k, doc_id, i, lines[i] AS line,
         translate(trim(lines[i], chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT k, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), crowded AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 20 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT l.*, coalesce(doc_id <> last, false) AS gone FROM l LEFT JOIN crowded USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY k
""",
    "op13_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), parts AS (
  SELECT doc_id, n, form, text, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
