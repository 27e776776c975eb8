"""The registered queries of the operators in this subpackage."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import (
    decontaminate, embedding_dedup, hard_negatives, licenses, ngram_lm, packing, periodic_runs, quality,
    simhash, tool_calls, toxicity, url_rules, weighted_sampling)
from folioloom.llm.common import small_batches, split_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    pieces = packing.tokenize(
        table(spark, sf_dir, "documents"), tokenizer or tokenizer_path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def held_out(remainder: int, parts: int):
    return F.coalesce(split_of("doc_id", parts) == remainder, F.lit(False))


def judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out(2, 4).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return judged(quality.score(docs.select("doc_id", "text"), model), quality.THRESHOLD)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


#: The tools that turns of a conversation are taken for.
TURN = {"type": "object", "additionalProperties": False, "required": ["text", "turn"], "properties": {
    "text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}
TOOLS = {"user": TURN, "system": TURN}


def conversation_calls(turns: DataFrame) -> DataFrame:
    """Turns as tool messages: an assistant's turn is the result of the turn before it; any other
    turn is a call, which depends on the call that was answered just before."""
    def at(back: int):
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))

    answer = F.coalesce(F.col("role") == "assistant", F.lit(False))
    return turns.select(
        "conv_id", "turn", F.when(answer, "result").otherwise("call").alias("kind"),
        F.when(answer, at(1)).otherwise(at(0)).alias("call_id"), F.when(~answer, F.col("role")).alias("name"),
        F.when(~answer, F.to_json(F.struct("text", "turn"), {"ignoreNullFields": "false"})).alias("arguments"),
        F.when(~answer & (F.col("turn") >= 2), F.array(at(2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
        F.when(answer, F.col("text")).alias("content"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return tool_calls.link(conversation_calls(turns), TOOLS).withColumn("errors", F.array_join("errors", "; "))


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score(table(spark, sf_dir, "documents"))
    return scored.withColumn("held_out", held_out(0, 10)).drop("training")


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.rules_of(spark))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return judged(toxicity.score(docs.select("doc_id", "text"), model), toxicity.THRESHOLD)


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.neighbours(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    def whole(x):
        x = 256 * x.cast("double")
        # Larger numbers are whole; what is no finite number stays so.
        return F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x)

    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", whole).alias("vector"))
    return hard_negatives.mine(rows, anchor=F.col("vec_id") % 100 == 0)


def woven(ids: pa.Array, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The words of every tenth id, by its hash, repeat themselves from some word on."""
    codes = codes.copy()
    for i, doc_id in enumerate(ids.to_pylist()):
        lo, n = int(starts[i]), int(starts[i + 1] - starts[i])
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            codes[lo + a:lo + n] = codes[lo + a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))]
    return codes


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs_of(table(spark, sf_dir, "documents"), rewrite=woven)
    none = F.lit(None).cast(periodic_runs.RUN)
    # The runs come by start and period, so the first of equally great exponents stays.
    best = F.aggregate("runs", none, lambda most, run: F.when(
        most.isNull() | (run["length"] * most["period"] > most["length"] * run["period"]), run).otherwise(most))
    lines = F.array_join(F.transform("runs", lambda run: F.concat(
        F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start"), F.col("best.length"),
        F.col("best.period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_ranking": op4_quality_ranking,
    "op5_license_scan": op5_license_scan,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_tool_calls": op7_tool_calls,
    "op8_backoff_lm": op8_backoff_lm,
    "op9_toxicity": op9_toxicity,
    "op10_url_rules": op10_url_rules,
    "op11_weighted_sampling": op11_weighted_sampling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}


def words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{url_rules.CAPITALS}', '{url_rules.CAPITALS.lower()}'), "
            r"'[0-9a-z\x{80}-\x{10FFFF}]+')")


#: All windows of all items looked up at every place of every document.
OP1_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS n_row, doc_id, {words_sql('text')} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {words_sql('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS k FROM items WHERE len(w) > 0) i),
places AS (
  SELECT n_row, n, k, array_to_string(w[k:k + n - 1], ' ') AS t
  FROM (SELECT n_row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k
        FROM docs, (SELECT DISTINCT n FROM windows) l WHERE len(w) >= n) d),
hits AS (SELECT n_row, k, places.n, item FROM places JOIN windows ON places.t = windows.t AND places.n = windows.n),
words_hit AS (
  SELECT n_row, count(DISTINCT k + j) AS n_hit FROM (SELECT n_row, k, unnest(range(n)) AS j FROM hits) h GROUP BY n_row),
owners AS (
  SELECT n_row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT n_row, item FROM hits WHERE item IS NOT NULL) h GROUP BY n_row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN words_hit USING (n_row) LEFT JOIN owners USING (n_row)"""

#: Every pair of a label, and everything that links lead to.
OP2_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON e.vec_id = r.a
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON e.vec_id = l.a"""

#: The score of every row for every anchor.
OP12_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, b.label,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""

#: SQL for DuckDB, where it can say the same.
ORACLES: dict[str, str] = {
    "op1_decontamination": OP1_SQL, "op2_embedding_dedup": OP2_SQL, "op10_url_rules": url_rules.oracle(),
    "op12_hard_negatives": OP12_SQL}
