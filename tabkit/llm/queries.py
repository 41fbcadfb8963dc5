"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, html, infill, packing, pitman_yor, quality, secrets, sharding, simhash, substrings, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_sampled_splitters")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs, shards=40)


SQL_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+2], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win), range(3) AS r(j) WHERE c > 1 GROUP BY doc_id),
line AS (SELECT doc_id, l, {SQL_WORDS.format("l")} AS lw FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
judged AS (SELECT doc_id, l, lw, len(lw) AS n, len(array_to_string(lw, '')) AS chars,
  len(l) - len(regexp_replace(l, '{quality.MARKS}', '', 'g')) AS marks, len(l) - len(regexp_replace(l, '[|»›·•]', '', 'g')) AS bars,
  regexp_matches(l, '{quality.SENTENCE_END}') AS ends, regexp_matches(l, '{quality.BOILERPLATE}') AS stock FROM line WHERE len(lw) > 0),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS dup,
  sum(CASE WHEN NOT ends OR stock OR 100 * marks > {quality.MARKS_PER_100_WORDS} * n OR 100 * bars > {quality.SEPARATORS_PER_100_WORDS} * n THEN chars ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) AND 100 * lost <= {quality.MAX_LOST_PERCENT} * word_chars AS kept
FROM m"""


@query("op5_line_first_cleaning", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_minimum_bin_slack")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path())


@query("op8_entropy_scan")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")


@query("op10_line_block_text")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op1_vantage_point_simhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=3, radius=2)


SQL_SHINGLES = """unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, {SQL_WORDS.format("lower(coalesce(text, ''))")} AS w FROM documents),
b AS (SELECT item_id, {SQL_WORDS.format("lower(coalesce(text, ''))")} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, {SQL_SHINGLES} AS s FROM d)),
bs AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, {SQL_SHINGLES} AS s FROM b)),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_shingles, shared AS n_shared, CAST(shared AS DOUBLE) / n AS containment
FROM hit JOIN n USING (item_id) WHERE 100 * shared >= {decontaminate.MIN_CONTAINMENT_PERCENT} * n"""


@query("op9_minhash_containment", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.containments(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_fm_index_repeats")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents"))


@query("op6_pitman_yor_scores")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, folder, "documents"))


@query("op3_minimum_cost_roles")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair_roles(table(spark, folder, "conversations"))


@query("op11_naive_bayes_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where("crc32(cast(doc_id AS string)) % 3 <> 1"))
    scored = toxicity.apply(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.expr("crc32(cast(doc_id AS string)) % 3 = 1").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op12_fm_index_collocations")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
x AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS r1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS r2,
  n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 AS plain,
  CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 AS spm FROM d),
c AS (SELECT *, least(r1, r2) AS a, greatest(r1, r2) AS b FROM x)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN NOT plain THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c"""


@query("op13_skip_list_infill", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    made = infill.infill(table(spark, folder, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)
