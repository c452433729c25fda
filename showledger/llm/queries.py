"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showledger.session import adopt

from . import byte_bpe, chat_format, exact_dedup, html_extract, jaccard_join, kneser_ney, lexical_search, quality_pu, resampling, sharding, toxicity, url_filter, winnowing
from .common import read

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            adopt(spark)
            return fn(spark, folder)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_pu.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coder = byte_bpe.ByteBPE(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.report(read(spark, folder, "documents"), coder)


@query("op3_decontamination", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n FROM d, (SELECT DISTINCT n FROM item_windows)), unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT doc_id, item_id, i, n FROM doc_windows JOIN item_windows USING (n, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.report(read(spark, folder, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op6_chat_format")
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(
            F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("t"))
    said = own.select("conv_id", "t.turn", "t.role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.report(read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(said))


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.report(read(spark, folder, "documents"))


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.report(read(spark, folder, "pages"))


@query("op9_exact_dedup", r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""")
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, folder, "documents"))


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"))


@query("op11_importance_resampling", r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i))),
docs AS (
  SELECT doc_id, row_number() OVER () AS row_at,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
words AS (SELECT row_at, unnest(w) AS word FROM docs),
bucket_of AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word, hex(word) AS h FROM (SELECT word FROM words UNION SELECT word FROM target)), crc_table),
s AS (SELECT bucket, count(*) AS s FROM words JOIN bucket_of USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM target JOIN bucket_of USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
                                      / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
weighed AS (SELECT row_at, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN bucket_of USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (row_at)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed""")
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op12_lm_scoring")
def op12_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.report(read(spark, folder, "documents"))


@query("op13_lexical_search", r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_at,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
totals AS (SELECT count(*) AS docs, sum(len(w)) AS terms FROM d WHERE len(w) > 0),
items AS (
  SELECT item_at, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT *, row_number() OVER () AS item_at FROM benchmark)),
held AS (SELECT row_at, unnest(w) AS term FROM d),
tf AS (SELECT row_at, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM items) GROUP BY 1, 2),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), totals),
hits AS (
  SELECT item_at, item_id, doc_id, row_at,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + CAST((90 * CAST(len(w) AS BIGINT) * docs) // terms AS BIGINT))))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weight USING (term) JOIN d USING (row_at), totals GROUP BY ALL),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_at ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM hits WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10""")
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
