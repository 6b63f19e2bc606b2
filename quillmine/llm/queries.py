"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontaminate, hardneg, langid, mixing, pii, quality, repeats, simhash, tokens, topk, toxicity, urlfilter
from .sampling import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    counts = [pii.count(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.digest("base"), 256).alias("base_sha256"), pii.digest("spans").alias("spans"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    found = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the pages that came by a feed (``utm_source=``); their other spellings are blocked with them."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, pages.select("url").where(F.contains("url", F.lit("utm_source="))))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.grade(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "severity", "grade", "score", F.col("toxic").cast("int").alias("predicted"), "toxic")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), repeats=True)


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.covered(F.col("hits"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some labels are wrong on purpose: where vec_id is divisible by 7, the next of ten labels stands for the row's own."""
    own = F.col("label").cast("long")
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own).alias("label"), topk.quantised(F.col("embedding"), 256).alias("v"))
    return hardneg.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


QUERIES = {
    "op1_pii": op1_pii, "op2_langid": op2_langid, "op3_quality": op3_quality, "op4_urlfilter": op4_urlfilter, "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash, "op7_topk": op7_topk, "op8_tokens": op8_tokens, "op9_mixing": op9_mixing, "op10_decontaminate": op10_decontaminate,
    "op11_audit": op11_audit, "op12_repeats": op12_repeats, "op13_hardneg": op13_hardneg,
}

_UPPER, _LOWER = urlfilter._UPPER, urlfilter._LOWER

_OP4 = f"""
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hp AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
keyed AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html?|/)+$', '') END AS key FROM hp),
list AS (SELECT DISTINCT key AS k FROM keyed WHERE contains(url, 'utm_source=') AND key <> ''),
rules(v, h, p) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urlfilter.RULES)}),
ranked AS (
  SELECT page_id, host, path, key, h || p AS rule, v,
    row_number() OVER (PARTITION BY page_id, url ORDER BY length(h || p) DESC NULLS LAST) AS n
  FROM keyed LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN k IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  rule IS NULL AND k IS NOT NULL AS listed
FROM ranked LEFT JOIN list ON key = k WHERE n = 1
"""

_OP7 = """
WITH q AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_OP9 = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS INTEGER)] AS w FROM sources),
leveled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY source_size::DOUBLE / w, source IS NULL, source)),
aims AS (
  SELECT source AS s, source_size,
    CASE WHEN 2.0::DOUBLE * source_size < level * w THEN 2.0::DOUBLE * source_size
      ELSE max(level) FILTER (WHERE NOT 2.0::DOUBLE * source_size < level * w) OVER () * w END AS target
  FROM leveled),
numbered AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY CAST(floor(log2(size::DOUBLE + 1) * 16) AS INTEGER),
      substr(md5(coalesce(doc_id::VARCHAR, '-')), 1, 2), doc_id) AS k,
    ('0x' || substr(md5('0' || coalesce('s' || source, '-')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM sized),
mixed AS (
  SELECT doc_id, size, source_size, target, k, u, coalesce(target / nullif(source_size, 0), 0)::DOUBLE AS e
  FROM numbered JOIN aims ON source IS NOT DISTINCT FROM s)
SELECT doc_id, size, source_size, target, (floor(e * k + u) - floor(e * (k - 1) + u))::BIGINT AS copies,
  ((floor(e * k + u) - floor(e * (k - 1) + u)) * size)::BIGINT AS taken
FROM mixed
"""

_OP10 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
grams AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, p, n, item_id FROM grams JOIN windows USING (n, g)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

_OP11 = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), FALSE) AS later FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
marks AS (SELECT doc_id AS id, max((quality IS NOT DISTINCT FROM 1)::INT) AS g, max((toxic IS NOT DISTINCT FROM 1)::INT) AS x FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (
  SELECT part, (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
      + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * later::INT AS mask,
    coalesce(g, 0) AS g, coalesce(x, 0) AS x
  FROM w LEFT JOIN marks ON doc_id = id),
cells AS (SELECT part, mask, count(*) AS n, sum(g) AS g, sum(x) AS x FROM judged GROUP BY part, mask),
l(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS o, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM l p JOIN l q ON q.b <> p.b JOIN l r ON r.b NOT IN (p.b, q.b) JOIN l s ON s.b NOT IN (p.b, q.b, r.b) JOIN l t ON t.b NOT IN (p.b, q.b, r.b, s.b)),
steps AS (SELECT o, k AS step, bits[k] AS b, coalesce(list_sum(bits[1 : k - 1]), 0)::INT AS before FROM orders, (SELECT unnest(range(1, 6)) AS k)),
counted AS (
  SELECT part, o, step, b, sum(n) FILTER (WHERE mask & (before + b) = 0) AS kept, sum(n) FILTER (WHERE mask & before = 0 AND mask & b > 0) AS removed,
    sum(n) FILTER (WHERE mask & before > 0 AND mask & b > 0) AS redundant, sum(n) FILTER (WHERE mask = b) AS alone,
    sum(g) FILTER (WHERE mask & before = 0 AND mask & b > 0) AS good, sum(x) FILTER (WHERE mask & before = 0 AND mask & b > 0) AS toxic
  FROM cells, steps GROUP BY part, o, step, b)
SELECT part, o AS filter_order, step::INTEGER AS step, o[step] AS filter, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(alone, 0)::BIGINT AS unique_fails, coalesce(good, 0)::BIGINT AS good_lost, coalesce(toxic, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, b))::BIGINT AS shapley
FROM counted
"""

_OP13 = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.v AS anchor, a.label AS own, b.vec_id AS id, b.label AS label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, anchor, own ORDER BY score DESC, id) AS n FROM pairs WHERE label = own),
ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, q.id AS negative_id, p.score AS positive_score, q.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.anchor, p.own, p.n ORDER BY q.score DESC, q.id) AS k
  FROM positives p JOIN pairs q ON p.anchor_id = q.anchor_id AND p.anchor = q.anchor AND p.own = q.own AND q.label <> q.own
  WHERE p.n <= 5 AND 30 * p.score <= 100 * q.score AND 100 * q.score <= 90 * p.score)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE k <= 10
"""

#: The other operators are trained, or need hashes or tokenizers that DuckDB lacks; tests compare them with brute force.
ORACLES = {"op4_urlfilter": _OP4, "op7_topk": _OP7, "op9_mixing": _OP9, "op10_decontaminate": _OP10, "op11_audit": _OP11, "op13_hardneg": _OP13}
