"""The registered query of every operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm import (
    alignment,
    bpe,
    decontaminate,
    html_text,
    near_dedup,
    quality,
    sharding,
    simhash,
    span_dedup,
    token_counts,
    token_files,
    toxicity,
    turns,
)
from veleta.llm.tables import table
from veleta.session import run_dir


def op1_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    return token_files.read_digests(spark, path)


def op2_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = span_dedup.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_sentences", "n_removed", "text")


def op5_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.visible_text(table(spark, sf_dir, "pages"))


def op6_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, weights)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    ratios = quality.fit_ratio(docs, quality.trusted_texts(docs, labels))
    return quality.measure(docs, ratios).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op8_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.assign_shards(docs, shards=16)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults that the contract of op11 puts in, by a hash of conversation and turn."""
    fault = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.withColumn("fault", fault).filter("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations")
    repaired = turns.repair(turns.ordered_turns(damaged(source), copies=F.col("copies")))
    ids = source.select("conv_id").distinct().alias("o")
    out = ids.join(repaired.alias("r"), F.col("o.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    counts = [F.coalesce(f"r.{c}", F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("o.conv_id", *counts, F.coalesce("r.audit", F.lit("")).alias("audit"), F.coalesce("r.repaired_sha256", empty).alias("repaired_sha256"))


def op12_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op13_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simple8b_tokens,
        op2_bag_minhash,
        op3_viterbi_counts,
        op4_sentence_spans,
        op5_layout_text,
        op6_ftrl_toxicity,
        op7_ngram_ratio,
        op8_containment,
        op9_feistel_shards,
        op10_bpe_transducer,
        op11_cyk_repair,
        op12_fragment_alignment,
        op13_simhash_ring,
    )
}
# The others have no form in SQL that DuckDB can run over whole tables.
ORACLES: dict[str, str] = {"op8_containment": decontaminate.SQL}
