"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm import (
    arc_convert,
    bootstrap_pii,
    byte_cnn,
    cross_tokens,
    decontaminate,
    histogram_sort,
    line_crf,
    list_join,
    mixing,
    near_dedup,
    page_diff,
    prefix_trie,
    resample,
)
from pulsemill.llm.common import table
from pulsemill.llm.trie_sql import OP13_SQL


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and line labels of every document, and whether it stays."""
    docs = table(spark, sf_dir, "documents")
    return line_crf.line_quality(docs, line_crf.fit(docs, table(spark, sf_dir, "labels")))


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through legacy archives into WARC and back."""
    return arc_convert.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))[0]


def op4_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return histogram_sort.shard_rows(table(spark, sf_dir, "documents"))


def op5_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mix = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op6_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document, and whether the sample holds it."""
    return resample.quality_sample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.languages(docs, byte_cnn.fit(docs))


def _number(*parts: str | Column) -> Column:
    """28 bits of a hash that SQL engines share."""
    text = F.concat_ws("/", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


YEAR_START, YEAR_SECONDS, MONTH_SECONDS = 1_704_067_200, 31_536_000, 2_628_000


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time in 2024 that follows from the page_id."""
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", (YEAR_START + _number("page_id") % YEAR_SECONDS).alias("fetched_at"))


def list_entries(seen: DataFrame) -> DataFrame:
    """A list log that grows with the captures.

    Every month lists each host seen in it, anew or not; the first path segments of hosts
    are listed once; every fifth path is listed by itself. Actions and times are hashed.
    """
    named = seen.withColumn("host", list_join.host_of(F.col("url"))).withColumn(
        "path", list_join.path_of(F.col("url"))).where("host <> ''")
    month = F.floor((F.col("fetched_at") - YEAR_START) / MONTH_SECONDS).alias("month")
    hosts = named.select("host", month).distinct().select(
        F.concat(F.lit("d:"), "host").alias("pattern"), _number("host", "month", F.lit("a")).alias("pick"),
        (YEAR_START + F.col("month") * MONTH_SECONDS + _number("host", "month") % MONTH_SECONDS).alias("at"))
    top = F.regexp_extract("path", "^(/[^/]*/)", 1).alias("top")
    tops = named.select("host", top).where("top <> ''").distinct().select(
        F.concat(F.lit("p:"), "host", "top").alias("pattern"), _number("host", "top", F.lit("a")).alias("pick"),
        (YEAR_START + _number("host", "top") % YEAR_SECONDS).alias("at"))
    single = named.where(_number("page_id", F.lit("list")) % 5 == 0).select(
        F.concat(F.lit("p:"), "host", "path").alias("pattern"),
        _number("page_id", F.lit("a")).alias("pick"),
        (YEAR_START + _number("page_id", F.lit("at")) % YEAR_SECONDS).alias("at"))
    action = F.when(F.col("pick") % 3 == 0, "block").when(F.col("pick") % 3 == 1, "allow").otherwise("drop")
    return hosts.union(tops).union(single).select("pattern", action.alias("action"), "at")


def op9_temporal_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active when it was fetched."""
    seen = captures(spark, sf_dir)
    return list_join.as_of(seen, list_entries(seen))


def op10_prefix_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two public tokenizers over every document."""
    return cross_tokens.aligned(table(spark, sf_dir, "documents"))


def op12_bootstrap_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return bootstrap_pii.personal_data(table(spark, sf_dir, "documents"))[0]


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_line_crf": op1_line_crf,
    "op2_arc_to_warc": op2_arc_to_warc,
    "op3_probminhash": op3_probminhash,
    "op4_histogram_sort": op4_histogram_sort,
    "op5_weighted_mix": op5_weighted_mix,
    "op6_page_diff": op6_page_diff,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_byte_cnn": op8_byte_cnn,
    "op9_temporal_list": op9_temporal_list,
    "op10_prefix_set_join": op10_prefix_set_join,
    "op11_cross_tokens": op11_cross_tokens,
    "op12_bootstrap_pii": op12_bootstrap_pii,
    "op13_prefix_trie": op13_prefix_trie,
}

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS size,
         array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
spans AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hits AS (SELECT s.rid, s.i, s.size, v.item FROM spans s JOIN windows v ON s.win = v.win AND s.size = v.size),
n AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hits) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN items USING (rid)
"""

OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, CASE WHEN bool_and(coalesce(quality, 1) > 0 AND coalesce(toxic, 0) = 0)
                      THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS weight
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '') || 'mix-1') AS row_key
  FROM documents
), k AS (
  SELECT d.*, -ln((CAST('0x' || substr(row_key, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
              / coalesce(weight, 1.0::DOUBLE) AS key
  FROM d LEFT JOIN l USING (doc_id)
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM k GROUP BY source
), r AS (SELECT *, CAST(3 * source_size AS DOUBLE) / w AS reach FROM s),
levels AS (
  SELECT *, CAST((sum(source_size) OVER ()) - 3 * coalesce(sum(source_size) OVER before, 0) AS DOUBLE)
            / ((sum(w) OVER ()) - coalesce(sum(w) OVER before, 0)) AS level,
         row_number() OVER (ORDER BY reach, source NULLS LAST) AS place
  FROM r WINDOW before AS (ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (SELECT arg_min(level, place) AS level FROM levels WHERE level <= reach),
t AS (
  SELECT source, source_size, least(c.level * w, CAST(3 * source_size AS DOUBLE)) AS target
  FROM levels, chosen c
), placed AS (
  SELECT k.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * source_size)
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

_NUM = "CAST('0x' || substr(md5({}), 1, 7) AS BIGINT)"
OP9_SQL = r"""
WITH c AS (
  SELECT row_number() OVER () AS rid, page_id, url,
         1704067200 + @{CAST(page_id AS VARCHAR)} % 31536000 AS fetched_at,
         lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1),
               '^[^@]*@|:[0-9]*$|\.$', '', 'g')) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS raw
  FROM pages
), n AS (
  SELECT *, CASE WHEN raw = '' THEN '/' ELSE raw END AS path,
         CAST(floor((fetched_at - 1704067200) / 2628000) AS BIGINT) AS month
  FROM c
), log AS (
  SELECT 'd:' || host AS pattern, @{host || '/' || month || '/a'} AS pick,
         1704067200 + month * 2628000 + @{host || '/' || month} % 2628000 AS since
  FROM (SELECT DISTINCT host, month FROM n WHERE host <> '')
  UNION ALL
  SELECT 'p:' || host || top, @{host || '/' || top || '/a'}, 1704067200 + @{host || '/' || top} % 31536000
  FROM (SELECT DISTINCT host, regexp_extract(path, '^(/[^/]*/)', 1) AS top FROM n WHERE host <> '')
  WHERE top <> ''
  UNION ALL
  SELECT 'p:' || host || path, @{page_id || '/a'}, 1704067200 + @{page_id || '/at'} % 31536000
  FROM n WHERE host <> '' AND @{page_id || '/list'} % 5 = 0
), entries AS (
  SELECT pattern, since, min(CASE pick % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END) AS act FROM log GROUP BY pattern, since
), v AS (
  SELECT pattern, act, since AS valid_from, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS valid_to FROM entries
), probes AS (
  SELECT rid, fetched_at, unnest(list_distinct(list_concat(
    list_transform(range(1, len(labels) + 1), lambda k: 'd:' || array_to_string(labels[len(labels) - k + 1:], '.')),
    list_transform(range(1, len(parts) + 1), lambda k: 'p:' || host || array_to_string(parts[:k], '/')
      || CASE WHEN k < len(parts) THEN '/' ELSE '' END)))) AS pattern
  FROM (SELECT *, string_split(host, '.') AS labels, string_split(path, '/') AS parts FROM n WHERE host <> '')
), hit AS (
  SELECT rid, p.pattern, act, valid_from, row_number() OVER (PARTITION BY rid
    ORDER BY starts_with(p.pattern, 'p:') DESC, length(p.pattern) DESC, p.pattern DESC) AS k
  FROM probes p JOIN v ON p.pattern = v.pattern AND fetched_at >= valid_from
    AND (valid_to IS NULL OR fetched_at < valid_to)
  WHERE act < 2
)
SELECT page_id, url, fetched_at, hit.pattern, CASE act WHEN 0 THEN 'block' WHEN 1 THEN 'allow' END AS action,
       valid_from, coalesce(act = 0, false) AS blocked
FROM n LEFT JOIN hit ON n.rid = hit.rid AND hit.k = 1
"""
OP9_SQL = re.sub(r"@\{(.*?)\}", lambda m: _NUM.format(m[1]), OP9_SQL)

OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, coalesce(html, '') AS payload,
         sha1(coalesce(html, '')) AS h
  FROM pages
), d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT)
                 >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS digest,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""

ORACLES = {"op2_arc_to_warc": OP2_SQL, "op9_temporal_list": OP9_SQL, "op5_weighted_mix": OP5_SQL, "op10_prefix_set_join": OP10_SQL,
           "op13_prefix_trie": OP13_SQL}
