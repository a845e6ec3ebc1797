"""A training-corpus pipeline: each stage reads what the one before kept, written as Parquet in the shared folder.

1. Language identification: documents without a letter, or whose language is less likely than not, go.
2. Line dedup: lines of any length that repeat an earlier one, and those of 20 characters or more that are one edit
   from it, go, and documents of which nothing is left. Blank lines stay.
3. Near-duplicates: of each group of linked fingerprints one document stays.
4. Decontamination: documents with a window of a benchmark item go.
5. Byte-level BPE: documents as token ids, checked by decoding.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.llm.bpe import encode_documents
from ctxloom.llm.common import read_table, stored
from ctxloom.llm.decontaminate import drop_contaminated
from ctxloom.llm.langid import UNKNOWN, held_out, identify, train
from ctxloom.llm.line_dedup import without_repeated_lines
from ctxloom.llm.simhash import near_duplicates_removed
from ctxloom.llm.vocabularies import pretoken_pattern, read_ranks

MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The languages are learnt from ``docs`` themselves; where none of them has a label, documents with a letter stay."""
    model = train(docs.filter(~held_out(F.col("doc_id"))), read_ranks("byte_bpe_multi_50k.tiktoken"))
    found = identify(docs.select(F.struct("*").alias("row")), model, "row.text")
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    stay = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.filter(stay).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text where there is such a column."""
    kept = without_repeated_lines(docs, min_chars=None)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates_removed(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids and the text that they decode to."""
    ranks = read_ranks("byte_bpe_50k.tiktoken")
    decoded = encode_documents(docs, ranks, pretoken_pattern(), decoded=True)
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text")
    )


STAGES = [
    ("language ID", language_id), ("line dedup", line_dedup), ("near-dedup", near_dedup),
    ("decontamination", decontaminate), ("tokens", tokenize),
]

#: Language identification, SimHash and merges are not to be had in SQL; the tests go through the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
