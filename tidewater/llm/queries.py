"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import bpe_decode, bpe_encode
from tidewater.llm.common import documents
from tidewater.llm.conversation_repair import Repair
from tidewater.llm.fertility import quality_rules
from tidewater.llm.line_dedup import MIN_WORDS, line_report
from tidewater.llm.ngram_join import jaccard_components
from tidewater.llm.packing import pack, token_pieces
from tidewater.llm.periodic_runs import periodic_runs
from tidewater.llm.personal_data import find_personal_data
from tidewater.llm.quality import quality_scores
from tidewater.llm.secrets import find_secrets
from tidewater.llm.suffix_dedup import cut_repeats
from tidewater.llm.toxicity import toxicity_scores
from tidewater.llm.vector_join import embedding_components
from tidewater.llm.vocab import Vocabulary

#: Tokens of a packed sequence.
SEQUENCE_TOKENS = 1024


def op1_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe_encode(documents(spark, sf_dir), vocab, keep=["doc_id"]).withColumn("n_tokens", F.size("ids").cast("long"))
    done = bpe_decode(ids, vocab, keep=["doc_id", "n_tokens"], with_text=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pack(token_pieces(documents(spark, sf_dir), vocab, SEQUENCE_TOKENS), SEQUENCE_TOKENS)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_novel"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark, documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_added"
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; of one text in ten all words from a place on repeat a stretch, as the contract of op12 says."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    d = d.withColumn("n", F.size("words")).withColumn("a", (F.col("g") % F.when(F.col("n") > 0, F.col("n"))).cast("int"))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    made = F.expr(
        "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)), ' ')"
    )
    return d.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(with_periods(documents(spark, sf_dir)), keep=["doc_id"]).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of conversations with the faults that the contract of op13 names; nulls are spaces."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    return conversations.where(h != 0).select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), F.when(h == 3, 2).otherwise(1).alias("copies")
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    done = Repair(damaged(conversations), copies_col="copies").digests("done_id")
    ids = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(done, F.col("conv_id").eqNullSafe(F.col("done_id")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_embedding_near_dups, op2_suffix_dedup, op3_bpe_round_trip, op4_best_fit_packing, op5_quality_classifier, op6_ngram_jaccard, op7_line_dedup, op8_secret_scan, op9_toxicity, op10_quality_rules, op11_personal_data, op12_periodic_runs, op13_conversation_repair)
    return {f.__name__: f for f in made}


#: Line dedup by its rule: every pair of equal lines, put together to maximal repeated runs; no windows, fingerprints or hashes.
_LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents WHERE length(text) > 0),
lines AS (
  SELECT doc_id, line, s, w, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k,
         lead(line) OVER (PARTITION BY doc_id ORDER BY line) AS next_line
  FROM (SELECT *, len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) AS w FROM split) WHERE w > 0),
met AS (
  SELECT b.doc_id, b.k, b.w, a.doc_id AS other, a.k - b.k AS shift
  FROM lines b JOIN lines a ON a.s = b.s AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.k < b.k))),
islands AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY k) AS island FROM met),
runs AS (
  SELECT doc_id, min(k) AS first, max(k) AS last FROM islands
  GROUP BY doc_id, other, shift, island HAVING sum(w) >= {MIN_WORDS}),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS k FROM runs),
gone_lines AS (
  SELECT g.doc_id, unnest(range(l.line, CASE WHEN lead(g.k) OVER (PARTITION BY g.doc_id ORDER BY g.k) = g.k + 1 THEN l.next_line ELSE l.line + 1 END)) AS line
  FROM gone g JOIN lines l USING (doc_id, k)),
kept AS (
  SELECT split.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
         coalesce(string_agg(s, chr(10) ORDER BY split.line) FILTER (g.line IS NULL), '') AS text
  FROM split LEFT JOIN gone_lines g ON g.doc_id = split.doc_id AND g.line = split.line GROUP BY split.doc_id)
SELECT d.doc_id, CAST(coalesce(k.n_lines, CASE WHEN d.text IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS n_lines,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, d.text)) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": _LINE_DEDUP}
