"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm import (
    chat,
    decontaminate,
    divergence,
    license_scan,
    line_dedup,
    neighbours,
    ngram_join,
    oracle,
    packing,
    pii,
    prefix_trie,
    quality_model,
    quality_rules,
    toxicity,
)

# A key for the given tables; real ones come from a secret store.
PII_KEY = "layerforge-demo-key"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that has a word, with the first line of its class, which is the one that stays."""
    found = line_dedup.line_classes(_table(spark, sf_dir, "documents"), min_words=1, min_chars=1)
    kept = (F.col("doc_id") == F.col("first_doc_id")) & (F.col("line") == F.col("first_line"))
    return found.select("doc_id", "line", "first_doc_id", "first_line", kept.alias("kept"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(_table(spark, sf_dir, "documents"))


def op5_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudonymised texts, and the number of values replaced per kind."""
    made = pii.pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    counts = [
        F.coalesce(F.try_element_at("pii", F.lit(kind.name)), F.lit(0).cast("long")).alias(f"n_{kind.name}")
        for kind in pii.KINDS
    ]
    return made.select("doc_id", "text", *counts)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    policies = quality_rules.POLICIES
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.failed(policies["base-1"]).alias("base_failed"),
        (~quality_rules.failed(policies["full-1"])).alias("kept"),
        "failed_bits",
    )


def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every rule of the full policy rejects, and what leaving it out would bring back."""
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    return quality_rules.ablation(rows, quality_rules.POLICIES["full-1"])


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings of other templates."""
    text = r"\\### Assistant: </turn> ok"
    planted = spark.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{text}'), (-7L, 1L, 'assistant', '{text}') AS t(conv_id, turn, role, text)"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.windows(turns.unionByName(planted)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    made = toxicity.scored(docs, model, keep=("doc_id", "lang"))
    return made.select("doc_id", "held_out", "score", "predicted", "flagged")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_model.train(docs, _table(spark, sf_dir, "labels"))
    return quality_model.scored(docs, model, keep=("doc_id",))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable(_table(spark, sf_dir, "embeddings"))
    return neighbours.search(vectors, vectors.where("id % 100 = 0"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Query]:
    listed = [
        op1_license_scan,
        op2_line_dedup,
        op3_benchmark_decontamination,
        op4_ngram_jaccard_join,
        op5_token_packing,
        op6_pii_pseudonyms,
        op7_quality_rules,
        quality_rule_ablation,
        op8_chat_formatting,
        op9_toxicity,
        op10_quality_classifier,
        op11_source_divergence,
        op12_nearest_neighbours,
        op13_conversation_trie,
    ]
    return {q.__name__: q for q in listed}


def oracle_sql() -> dict[str, str]:
    grams = {name: [license_scan.bigrams_of(t) for t in texts] for name, texts in license_scan.TEMPLATES.items()}
    return {
        "op1_license_scan": oracle.licenses(grams, license_scan.THRESHOLD),
        "op3_benchmark_decontamination": oracle.LEAKS,
        "op7_quality_rules": oracle.QUALITY,
        "quality_rule_ablation": oracle.ABLATION,
        "op8_chat_formatting": oracle.CHAT,
        "op11_source_divergence": oracle.DIVERGENCE,
        "op13_conversation_trie": oracle.TRIE,
    }
