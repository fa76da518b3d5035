"""The operators of this subpackage as queries on the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondscope.llm import (
    chat, decontamination, divergence, exact_dedup, infilling, language, licenses, line_dedup, mixing, near_dedup,
    quality, secrets, toxicity,
)
from bondscope.llm.common import documents


def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_documents(documents(spark, folder))


def near_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, folder))


def chat_query(spark: SparkSession, folder: str) -> DataFrame:
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(chat.formatted(given.union(added)))


def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.graded(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def exact_query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, folder))


def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def language_query(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return language.languages(documents(spark, folder), held_out)


def line_query(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.without_recurring_lines(documents(spark, folder))


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    return quality.resampled(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def license_query(spark: SparkSession, folder: str) -> DataFrame:
    templates = spark.createDataFrame([*licenses.STATEMENTS, *licenses.TAGGED], "license string, text string")
    return licenses.scanned(documents(spark, folder), templates)


def divergence_query(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audited(documents(spark, folder))


def infilling_query(spark: SparkSession, folder: str) -> DataFrame:
    made = infilling.infilled(documents(spark, folder))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def secret_query(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(documents(spark, folder))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != secrets.RANDOM)
    return found.select(
        "doc_id", *[of(kind).alias(f"n_{kind}") for kind in [*secrets.BASE, secrets.RANDOM]],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_mixing": mixing_query,
    "op2_minhash": near_query,
    "op3_line_dedup": line_query,
    "op4_chat": chat_query,
    "op5_toxicity": toxicity_query,
    "op6_quality": quality_query,
    "op7_exact_dedup": exact_query,
    "op8_decontamination": decontamination_query,
    "op9_licenses": license_query,
    "op10_language": language_query,
    "op11_divergence": divergence_query,
    "op12_infilling": infilling_query,
    "op13_secrets": secret_query,
}

ORACLE = {
    "op7_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
best AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM best""",
    "op8_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM bw WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, s.n, i FROM spots s JOIN windows USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_divergence": r"""
WITH g AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT lang, source, row, unnest(w) AS term FROM g),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
langs AS (SELECT lang, coalesce(sum(lang_n), 0)::HUGEINT AS n, count(term)::HUGEINT AS v
  FROM (SELECT DISTINCT lang FROM g) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM g) LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(c, 0) AS c, 1 + 1000000000 * (coalesce(c, 0) + 1) // (groups.n + v) AS p,
    1 + 1000000000 * (lang_n + 1)::HUGEINT // (langs.n + v) AS q
  FROM groups JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source)
SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source ORDER BY coalesce(value, 0) DESC, item)::INT AS rank
FROM every LEFT JOIN pairs USING (lang, source, item)
UNION ALL
SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT,
  row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term)::INT AS rank
FROM p WHERE c > 0 AND p > q QUALIFY rank <= 200""",
    "op12_infilling": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
    ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT doc_id, n, form, text, array_to_string(u[1:low], '') AS prefix, array_to_string(u[low + 1:high], '') AS middle,
    array_to_string(u[high + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM s""",
}
