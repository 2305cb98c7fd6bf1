"""The operators' registered queries and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthlake.llm import (
    bpe,
    classifier,
    dialogue,
    exact_dedup,
    html_extract,
    importance,
    mixing,
    paragraphs,
    quality,
    simhash,
    token_codes,
    url_filter,
    warc,
)
from monthlake.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), quality.trusted_of(table(spark, sf_dir, "labels")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents"))


def vocab_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_text(table(spark, sf_dir, "documents"))


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocab_path())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def byte_vocab_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.round_trip(table(spark, sf_dir, "documents"), byte_vocab_path())


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return dialogue.repair_report(dialogue.damage(conversations), conversations)


QUERIES = {f.__name__: f for f in (op1_mixing, op2_quality_rules, op3_exact_dedup, op4_url_filter, op5_html_extract, op6_warc, op7_substring_dedup,
                                   op8_classifier, op9_bpe, op10_simhash, op11_token_codes, op12_importance, op13_dialogue)}

OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, coalesce(text, '') AS text FROM documents),
drawn AS (
  SELECT doc_id, source, size,
    -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(text)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
    / (1.0 - 0.9 * least(1.0, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))) / greatest(size, 1))) AS k FROM sized),
src AS (
  SELECT source, source_size, w, 3 * source_size AS cap, pos FROM (
    SELECT *, CASE (pos - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM (
      SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM sized GROUP BY source))),
lev AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, pos) AS rnk,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY cap / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lvl FROM src),
cut AS (SELECT min(rnk) AS r, arg_min(lvl, rnk) AS l FROM lev WHERE lvl * w <= cap),
tgt AS (SELECT source, source_size, CASE WHEN r IS NULL OR rnk < r THEN cap::DOUBLE ELSE l * w END AS target FROM lev, cut),
j AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.k, d.source,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs FROM drawn d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
  sum(size) OVER (PARTITION BY source, k) AS tied FROM j)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN target - epochs * source_size > 0 AND 2 * cum - tied <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""

OP3_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

OP4_SQL = r"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
    nullif(regexp_extract(host || path, '(?:^|[^A-Za-z0-9])(casino|poker|porn|viagra|xxx)(?:[^A-Za-z0-9]|$)', 1), '') AS word
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN word END AS pattern
FROM judged
"""

OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS best FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to
FROM g
"""

# The CRC-32 of every distinct feature is folded over its bytes with a table made from the polynomial.
OP12_SQL = r"""
WITH RECURSIVE
table0 AS (SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM table0 WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM table0 WHERE k = 8),
low AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
goal AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
docf AS MATERIALIZED (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM low),
goalf AS MATERIALIZED (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM goal),
names AS (SELECT f FROM docf UNION SELECT f FROM goalf),
hashed AS MATERIALIZED (SELECT f, xor(list_reduce(list_transform(string_split(regexp_replace(hex(encode(f)), '(..)', '\1 ', 'g'), ' ')[:-2],
    lambda h: ('0x' || h)::UBIGINT), lambda c, b: xor(t[(xor(c, b) & 255)::INT + 1], c >> 8), 4294967295::UBIGINT), 4294967295::UBIGINT) % 10000 AS b
  FROM names, crc),
s AS (SELECT b, count(*) AS n FROM docf JOIN hashed USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM goalf JOIN hashed USING (f) GROUP BY b),
gain AS (SELECT s.b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
  / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (b)),
weights AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS g FROM docf JOIN hashed USING (f) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END AS weight,
  floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296.0)))::BIGINT AS noise
  FROM low LEFT JOIN weights USING (r)),
ranked AS (SELECT *, weight + noise AS score, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY weight + noise DESC, doc_id) END AS k,
  count(*) FILTER (WHERE words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN k <= 25 * n // 100 THEN k END AS rank FROM ranked
"""

ORACLE = {"op1_mixing": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op4_url_filter": OP4_SQL, "op6_warc": OP6_SQL,
          "op12_importance": OP12_SQL}
