"""Corpus encode: document table to token-array table.

The encoders are public libraries, called per Arrow batch. A vocabulary is broadcast once, after a
check of its size, and built once per Python worker.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ctxloom.functions.presets import PATTERNS
from ctxloom.operators.pretokenize import pretoken_expr
from ctxloom.runtime import parallelism, scratch_path, ship_package, store
from ctxloom.sources.listing import dataset_size
from ctxloom.sources.ranks import read_ranks

MAX_VOCAB_BYTES = 128 << 20
# Words at least this frequent travel by broadcast in the dictionary plan; there are at most as many.
HOT_WORDS = 10000
_HOT_WORD_BYTES = 256
_SALTS = 1024
_BLOCK_BYTES = 16 << 20
# Rows of a batch that are texts and lists of numbers in Python at once.
_ENCODED_ROWS = 256

_loaded: dict[Any, Any] = {}


@dataclass(frozen=True)
class Vocab:
    """A broadcast vocabulary: a rank table with its split pattern, or a tokenizer file."""

    backend: str
    data: Any
    pattern: str | None = None
    whole_words: bool = False

    def words_only(self) -> Vocab:
        """The same ranks for text that is already one pre-token."""
        return Vocab(self.backend, self.data, self.pattern, True)

    def encoder(self):
        """str -> int32 array, built once per worker process and vocabulary."""
        key = (self.data.value["id"], self.whole_words)
        if key not in _loaded:
            _loaded[key] = self._build()
        return _loaded[key]

    def _build(self):
        if self.backend == "ranks":
            import tiktoken

            pattern = r"(?s).+" if self.whole_words else PATTERNS[self.pattern]
            bpe = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=self.data.value["ranks"], special_tokens={}
            )
            if self.whole_words:  # short: a list costs a third of the way through a buffer
                return lambda text: np.array(bpe.encode_ordinary(text), dtype=np.int32)
            return lambda text: bpe.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        tok = tokenizers.Tokenizer.from_str(self.data.value["json"])
        return lambda text: np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype=np.int32)


def _check_size(spark: SparkSession, path: str) -> None:
    size = dataset_size(spark, path).first()[0]
    if size > MAX_VOCAB_BYTES:
        raise ValueError(f"vocabulary of {size} bytes is over the broadcast limit: {path}")


def load_rank_vocab(spark: SparkSession, path: str, pattern: str = "neox") -> Vocab:
    """Vocabulary from a rank file. Special tokens inside text are plain text to it."""
    if pattern not in PATTERNS:
        raise ValueError(f"unknown pattern: {pattern}")
    _check_size(spark, path)
    ranks = {bytes(r.token): r.rank for r in read_ranks(spark, path).collect()}
    return Vocab("ranks", spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "ranks": ranks}), pattern)


def load_hf_vocab(spark: SparkSession, path: str) -> Vocab:
    """Vocabulary from a ``tokenizer.json``."""
    _check_size(spark, path)
    text = spark.read.text(path, wholetext=True).first()[0]
    return Vocab("hf", spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "json": text}))


def token_lists(rows: list[np.ndarray]) -> pa.ListArray:
    """Arrow list<int32> from arrays."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _encode_udf(vocab: Vocab):
    @arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = vocab.encoder()
        for batch in batches:
            for at in range(0, len(batch), _ENCODED_ROWS):
                yield token_lists([run(text or "") for text in batch.slice(at, _ENCODED_ROWS).to_pylist()])

    return encode


def encode_corpus(
    df: DataFrame, vocab: Vocab, plan: str = "partition", ids: tuple[str, ...] = ("file", "ord"), text: str = "text"
) -> DataFrame:
    """(ids, tokens) of a document table.

    ``partition`` encodes each document where it lies. ``dictionary`` encodes each distinct pre-token
    once and joins the ids back; it pays for a shuffle of the text and of each block's different
    pre-tokens, so it suits slow encoders. Rows with the same ids come out as one there.
    """
    ship_package(df.sparkSession)
    docs = df.select(*ids, F.col(text).alias("text"))
    if plan == "partition":
        return docs.select(*ids, _encode_udf(vocab)("text").alias("tokens"))
    if plan != "dictionary":
        raise ValueError(f"unknown plan: {plan}")
    if vocab.backend != "ranks":
        raise ValueError("the dictionary plan needs the ranks backend")
    return _encode_by_dictionary(docs, vocab, ids)


def _encode_by_dictionary(docs: DataFrame, vocab: Vocab, ids: tuple[str, ...]) -> DataFrame:
    # Documents are dealt into blocks of bounded size. A block asks for each of its words once, so what is
    # shuffled, sorted and joined are its different words, not its text.
    spark = docs.sparkSession
    blocks = _block_count(docs)
    docs = docs.withColumn("_block", F.pmod(F.xxhash64(*ids), F.lit(blocks)))
    words = docs.select("_block", F.explode(pretoken_expr(F.col("text"), vocab.pattern)).alias("word"))
    asked = store(words.groupBy("_block", "word").agg(F.count(F.lit(1)).alias("n")), scratch_path(spark, "words"))
    # The dictionary is stored: three steps below read it, and none should encode again.
    counts = asked.groupBy("word").agg(F.sum("n").alias("n"))
    coded = counts.select("word", "n", _encode_udf(vocab.words_only())("word").alias("ids"))
    coded = store(coded, scratch_path(spark, "dictionary"))
    total = coded.agg(F.sum("n")).scalar()
    # A word with 1/HOT_WORDS of all occurrences is one of at most HOT_WORDS, each short: safe to broadcast.
    hot = (
        coded.filter((F.col("n") * HOT_WORDS >= total) & (F.octet_length("word") <= _HOT_WORD_BYTES))
        .select("word", F.col("ids").alias("hot_ids"))
    )
    staged = asked.select("_block", "word").join(F.broadcast(hot), "word", "left")
    # Words answered by the broadcast spread over salts that match nothing; the rest meet the dictionary.
    salt = F.concat(F.lit("s"), F.pmod(F.xxhash64("_block", "word"), F.lit(_SALTS)).cast("string"))
    staged = staged.withColumn("_key", F.when(F.col("hot_ids").isNotNull(), salt).otherwise(F.concat(F.lit("w"), "word")))
    cold = coded.select(F.concat(F.lit("w"), "word").alias("_key"), F.col("ids").alias("cold_ids"))
    answers = staged.join(cold, "_key", "left").select("_block", "word", F.coalesce("hot_ids", "cold_ids").alias("ids"))
    dealt = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_block").sortWithinPartitions("_block")
    split = dealt.select("_block", *ids, pretoken_expr(F.col("text"), vocab.pattern).alias("words"))
    schema = StructType([*[docs.schema[c] for c in ids], StructField("tokens", ArrayType(IntegerType()))])
    return split.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(_look_up, schema)


def _block_count(docs: DataFrame) -> int:
    """Blocks of about _BLOCK_BYTES of text; of a small table as many as there are cores."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, -(-size // _BLOCK_BYTES), min(parallelism(docs.sparkSession), size >> 20))


def _look_up(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """(ids, tokens) of a block's documents (block, ids, words), from its words' ids (block, word, ids)."""
    names = docs.column_names[1:-1]
    words = docs.column("words").combine_chunks()
    flat = words.flatten()
    known = answers.column("ids").combine_chunks()
    at = pc.index_in(flat, answers.column("word").combine_chunks())
    if at.null_count:
        raise ValueError("a word of a document has no ids")
    found = known.take(at)
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(found)), dtype=np.int64)])
    per_doc = np.asarray(pc.fill_null(pc.list_value_length(words), 0))
    firsts = np.concatenate([[0], np.cumsum(per_doc, dtype=np.int64)])
    keys = list(zip(*(docs.column(c).to_pylist() for c in names)))
    if len(set(keys)) < len(keys):
        return _merged(docs.select(names), keys, firsts, ends, np.asarray(found.flatten()))
    tokens = pa.ListArray.from_arrays(pa.array(ends[firsts], pa.int32()), found.flatten())
    return docs.select(names).append_column("tokens", tokens)


def _merged(docs: pa.Table, keys: list[tuple], firsts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row per key, where keys repeat: the words of its rows by their place, then by their ids."""
    rows: dict[tuple, list[int]] = {}
    for row, key in enumerate(keys):
        rows.setdefault(key, []).append(row)
    tokens = []
    for same in rows.values():
        places = [(i - firsts[row], i) for row in same for i in range(firsts[row], firsts[row + 1])]
        parts = sorted((pos, values[ends[i] : ends[i + 1]].tolist()) for pos, i in places)
        tokens.append(np.array([token for _, part in parts for token in part], dtype=np.int32))
    return docs.take(pa.array([same[0] for same in rows.values()])).append_column("tokens", token_lists(tokens))
