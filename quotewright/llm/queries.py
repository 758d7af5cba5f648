"""The corpus queries: each operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from quotewright.llm import (
    dedup,
    jaccard,
    language,
    licenses,
    mix,
    neighbours,
    packing,
    pii,
    quality,
    resample,
    runs,
    urls,
    warc,
)
from quotewright.llm.common import settle, table
from quotewright.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = settle(quality.with_statistics(table(spark, sf_dir, "documents")), "statistics")
    model = quality.fit_quality(measured, table(spark, sf_dir, "labels"))
    return quality.judge_quality(measured, model).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "score"
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.predict_language(documents, language.fit_language(documents))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.find_pii(documents, pii.fit_pii(documents))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "llm", f"archive-{uuid4().hex}")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), change=runs.planted)


def queries() -> dict[str, Query]:
    return {
        "op1_pack": op1_pack,
        "op2_quality": op2_quality,
        "op3_language": op3_language,
        "op4_pii": op4_pii,
        "op5_jaccard": op5_jaccard,
        "op6_warc": op6_warc,
        "op7_mix": op7_mix,
        "op8_url_filter": op8_url_filter,
        "op9_nearest": op9_nearest,
        "op10_license": op10_license,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_resample": op12_resample,
        "op13_runs": op13_runs,
    }


_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((part{part} >> {shift}) & 31) + 1, 1)"
    for part in range(8)
    for shift in (15, 10, 5, 0)
)
_PARTS = ", ".join(
    f"CAST('0x' || substr(digest, {5 * part + 1}, 5) AS INTEGER) AS part{part}" for part in range(8)
)

OP6_SQL = f"""
WITH pages_in AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, payload, sha1(payload) AS digest,
         CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes FROM pages_in
), cut AS (
  SELECT *, {_PARTS}, max(page_id) OVER (PARTITION BY payload) AS keeper FROM hashed
)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM cut
"""

OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM totals
), roomy AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS room FROM weighed
), shared AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM roomy
  WINDOW before AS (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), leveled AS (
  SELECT *, max(CASE WHEN room > level THEN level END) OVER () AS final_level FROM shared
), targets AS (
  SELECT source, source_size, weight,
         CASE WHEN room <= level THEN (3 * source_size)::DOUBLE ELSE weight * final_level END AS target
  FROM leveled
), quotas AS (
  SELECT *, floor(target)::BIGINT AS quota,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS passes FROM targets
), placed AS (
  SELECT s.doc_id, s.size, q.source_size, q.target, q.weight, q.quota, q.passes,
         q.quota - q.passes * q.source_size AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source
           ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id NULLS FIRST, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source
), taken AS (
  SELECT *, (passes * size + CASE WHEN rest > before AND 2 * (rest - before) >= size THEN size ELSE 0 END)::BIGINT AS taken FROM placed
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN
         CASE WHEN weight = 1 THEN before::DOUBLE / quota
              ELSE (sqrt(1 + (weight - 1.0::DOUBLE) * (1.0::DOUBLE + weight) * (before::DOUBLE / quota)) - 1) / (weight - 1.0::DOUBLE) END
       END AS position
FROM taken
"""

OP8_SQL = r"""
WITH cut AS (
  SELECT CAST(page_id AS BIGINT) AS page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules (rule, rule_host, rule_path, verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
         ('com/de/', 'com', '/de/', 'block')
), fitting AS (
  SELECT p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY ALL
)
SELECT p.page_id, p.host, p.path, f.rule,
       CASE WHEN f.verdict IS NOT NULL THEN f.verdict
            WHEN regexp_matches(p.host, '(^|[^a-z0-9])(cheap-pills|casino)($|[^a-z0-9])') THEN 'block'
            WHEN regexp_matches(p.path, '(?s)^/(.*/)?(login|cart)($|[^A-Za-z0-9])') THEN 'block'
            ELSE 'allow' END AS verdict
FROM parts p LEFT JOIN fitting f ON p.page_id = f.page_id AND p.host = f.host AND p.path = f.path
"""


OP11_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY text)
"""

OP12_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), texts AS (
  SELECT doc_id, FALSE AS wanted, text FROM documents UNION ALL SELECT NULL, TRUE, text FROM benchmark
), numbered AS (
  SELECT row_number() OVER () AS row_no, doc_id, wanted,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM texts
), tokens AS (
  SELECT row_no, wanted, unnest(words) AS word FROM numbered
), vocabulary AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(octet_length(encode(word))),
                          lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INTEGER, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM tokens), crc_table
), counted AS (
  SELECT bucket, count(*) FILTER (NOT wanted) AS s, count(*) FILTER (wanted) AS t
  FROM tokens JOIN vocabulary USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counted
), weights AS (
  SELECT row_no, sum(gain)::BIGINT AS weight
  FROM tokens JOIN vocabulary USING (word) JOIN gains USING (bucket) WHERE NOT wanted GROUP BY row_no
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                                               + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM numbered LEFT JOIN weights USING (row_no) WHERE NOT wanted
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_warc": OP6_SQL,
        "op7_mix": OP7_SQL,
        "op8_url_filter": OP8_SQL,
        "op11_exact_dedup": OP11_SQL,
        "op12_resample": OP12_SQL,
    }
