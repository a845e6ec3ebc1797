"""One registered query per operator, with production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.llm.bpe import encode_documents
from ctxloom.llm.chat import chain_of_turns, format_branches, read_back
from ctxloom.llm.common import read_table
from ctxloom.llm.decontaminate import find_contamination
from ctxloom.llm.langid import held_out, identify, train
from ctxloom.llm.line_dedup import mark_lines
from ctxloom.llm.merkle import build_manifest, document_leaves, fold_path, hex_text, proof_digest, prove
from ctxloom.llm.pii import KINDS, find_personal_data
from ctxloom.llm.pii import train as train_pii
from ctxloom.llm.quality_rules import apply_rules
from ctxloom.llm.quality_rules import train as train_rules
from ctxloom.llm.runs import find_runs, runs_text, with_periodic_tails
from ctxloom.llm.simhash import simhash_components
from ctxloom.llm.suffix_dedup import remove_repeats
from ctxloom.llm.token_count import count_tokens
from ctxloom.llm.vocabularies import pretoken_pattern, read_ranks, vocabulary_text
from ctxloom.llm.weighted_sampling import compare_with_edits, likeness, signature_text

TOKEN_LIMIT = 2048


def op1_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))), read_ranks("byte_bpe_multi_50k.tiktoken"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    marked = mark_lines(read_table(spark, sf, "documents"))
    return marked.select(
        F.col("_row.doc_id").alias("doc_id"), "n_lines", F.size("removed").cast("bigint").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    table = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    back = read_back(format_branches(chain_of_turns(table.unionByName(extra))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("conv").alias("conv_id"), "n_turns", F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    found = find_personal_data(docs, train_pii(docs))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, span: n + span[1] - span[0])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def op7_token_count(spark: SparkSession, sf: str) -> DataFrame:
    counted = count_tokens(read_table(spark, sf, "documents"), vocabulary_text("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, span: n + span[1] - span[0])
    return found.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = read_ranks("byte_bpe_50k.tiktoken")
    encoded = encode_documents(read_table(spark, sf, "documents"), ranks, pretoken_pattern(), decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_weighted_sampling(spark: SparkSession, sf: str) -> DataFrame:
    found = compare_with_edits(read_table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", signature_text("signature").alias("fingerprint"),
        signature_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"), likeness("signature", "next_signature").alias("near_next"),
    )


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = find_runs(with_periodic_tails(read_table(spark, sf, "documents").select("doc_id", "text")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(runs_text("runs"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every document is proven; the altered leaf, where there is one, is folded along the path of the original."""
    manifest = build_manifest(document_leaves(read_table(spark, sf, "documents")), ["doc_id"])
    proofs = prove(manifest, manifest.leaves.select("grp", "rank", "doc_id", "altered"))
    folded = proofs.withColumn("folded", fold_path(F.coalesce("altered", "digest"), F.col("path")))
    root = F.lit(manifest.root)
    return folded.select(
        "doc_id", hex_text(F.col("digest")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), hex_text(root).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), hex_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def op13_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    judged = apply_rules(docs, train_rules(docs, read_table(spark, sf, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("rule").cast("bigint").alias("rule"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_langid, op2_line_dedup, op3_chat_format, op4_simhash, op5_pii, op6_decontaminate, op7_token_count, op8_suffix_dedup, op9_bpe, op10_weighted_sampling,
           op11_periodic_runs, op12_merkle_manifest, op13_quality_rules]
    return {q.__name__: q for q in own}
