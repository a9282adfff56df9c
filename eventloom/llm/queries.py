"""The operators as queries over the driver's tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    decontam,
    lexical,
    mixing,
    neardup,
    pii,
    quality,
    rules,
    sql,
    structure,
    substring,
    tokens,
    topk,
    toxicity,
    warc,
)
from eventloom.llm.text import tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if check is not None:
            ORACLES[name] = check
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{folder}/{name}.parquet")


@query("op4_rule_ledger", sql.RULE_LEDGER)
def op4_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule on every document, under the latest policy."""
    judged = rules.apply_policy(rules.ledger(table(spark, folder, "documents")), max(rules.POLICIES))
    contract = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*contract, "fail_bits")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the public byte-level vocabulary."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return tokens.token_counts(table(spark, folder, "documents"), file.read())


@query("op7_substring_dedup", sql.SUBSTRING_DEDUP)
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words that an earlier document holds, cut from every document."""
    cut = substring.without_repeats(table(spark, folder, "documents"), 50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op9_near_duplicates", sql.NEAR_DUPLICATES)
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of 0.75 or more on shingles of five words."""
    return neardup.near_duplicates(table(spark, folder, "documents"), 5, 75)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, with the offending spans."""
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, folder, "labels")))


@query("op10_personal_data")
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data and secrets in every document."""
    found = pii.find(table(spark, folder, "documents"), pii.train())
    counts = [f"n_{kind}" for kind in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_secret")


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, folder, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, folder, "labels")))


@query("op6_benchmark_leaks")
def op6_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents, up to an edit distance of 8 percent of the item."""
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op1_warc_derivatives", sql.WARC_DERIVATIVES)
def op1_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and conversion records of every page, with their blocks as text."""
    made = warc.derivatives(warc.responses_of(table(spark, folder, "pages"), "2024-02-29T00:00:00Z"))
    return made.withColumn("block", F.col("block").cast("string"))


@query("op2_mixing")
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents drawn so that languages, topics and flattened sources meet their shares."""
    return mixing.mixed(table(spark, folder, "documents")).drop("text")


@query("op11_ranked_search", sql.RANKED_SEARCH)
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10)


@query("op12_structure_repair", sql.STRUCTURE_REPAIR)
def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations with the cheapest edits that make them legal."""
    return structure.repairs(structure.damaged(table(spark, folder, "conversations")))


@query("op13_exact_top_k", sql.EXACT_TOP_K)
def op13_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five rows of largest inner product for every 50th vector."""
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
