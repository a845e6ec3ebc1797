import json

import pyarrow as pa
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

from ctxloom.functions.presets import PATTERNS
from ctxloom.operators import encode as enc
from ctxloom.operators.encode import encode_corpus, load_hf_vocab, load_rank_vocab
from ctxloom.operators.pretokenize import pretoken_counts, pretokenize

from conftest import MERGES

ODD = [
    "", " ", "  \n\n x", "it's IT'S we'll 1234567 a1b2", "nbsp x y\u0085z　q​w", "日本語 text",
    "\r\n\n runs\t\tof\t space  ", "🙂🙂 ok", "١٢٣٤ digits", "the the then other", "a" * 300, "!?...\r\n\r\nend",
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    odd = spark.createDataFrame([(f"odd{i}", i, t) for i, t in enumerate(ODD)], "file string, ord long, text string")
    table = spark.read.parquet(f"{sf}/documents.parquet")
    return odd.unionByName(table.select(F.col("source").alias("file"), F.col("doc_id").alias("ord"), "text"))


def encoding(pattern):
    ranks = {bytes([i]): i for i in range(256)}
    for m in MERGES:
        ranks[m if isinstance(m, bytes) else m.encode()] = len(ranks)
    return tiktoken.Encoding("t", pat_str=PATTERNS[pattern], mergeable_ranks=ranks, special_tokens={})


def as_dict(df, col="tokens"):
    return {(r.file, r.ord): r[col] for r in df.collect()}


@pytest.mark.parametrize("pattern", ["neox", "llama3"])
def test_plans_equal_a_plain_loop(spark, docs, rank_file, pattern):
    vocab = load_rank_vocab(spark, rank_file, pattern)
    bpe = encoding(pattern)
    want = {(r.file, r.ord): bpe.encode_ordinary(r.text) for r in docs.collect()}
    assert as_dict(encode_corpus(docs, vocab)) == want
    assert as_dict(encode_corpus(docs, vocab, plan="dictionary")) == want


def test_dictionary_without_hot_words(spark, docs, rank_file, monkeypatch):
    monkeypatch.setattr(enc, "HOT_WORDS", 1)
    vocab = load_rank_vocab(spark, rank_file)
    few = docs.filter("file like 'odd%'")
    assert as_dict(encode_corpus(few, vocab, plan="dictionary")) == as_dict(encode_corpus(few, vocab))


@pytest.mark.parametrize("pattern", ["neox", "llama3"])
def test_pretokens_equal_the_regex_module(spark, docs, pattern):
    import regex

    pat = regex.compile(PATTERNS[pattern])
    got = as_dict(pretokenize(docs, pattern), "words")
    assert got == {(r.file, r.ord): pat.findall(r.text) for r in docs.collect()}


def test_pretoken_counts(spark, docs):
    few = docs.filter("file = 'odd9'")
    assert {r.word: r.n for r in pretoken_counts(few).collect()} == {"the": 1, " the": 1, " then": 1, " other": 1}


def test_hf_backend(spark, docs, tmp_path):
    words = {"[UNK]": 0, "the": 1, "ok": 2, "text": 3}
    tok = tokenizers.Tokenizer(tokenizers.models.WordLevel(words, unk_token="[UNK]"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    path = tmp_path / "tokenizer.json"
    path.write_text(tok.to_str())
    json.loads(path.read_text())
    vocab = load_hf_vocab(spark, str(path))
    want = {(r.file, r.ord): tok.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
    assert as_dict(encode_corpus(docs, vocab)) == want
    with pytest.raises(ValueError):
        encode_corpus(docs, vocab, plan="dictionary")


def test_vocabulary_size_is_checked(spark, rank_file, monkeypatch):
    monkeypatch.setattr(enc, "MAX_VOCAB_BYTES", 10)
    with pytest.raises(ValueError, match="broadcast limit"):
        load_rank_vocab(spark, rank_file)


def test_dictionary_sends_a_block_s_words_once(spark, tmp_path, rank_file):
    """Ten thousand times the same text: what meets the dictionary must not grow with it."""
    vocab = load_rank_vocab(spark, rank_file)
    many = spark.range(10000).select(F.lit("f").alias("file"), F.col("id").alias("ord"), F.lit("the quick other the").alias("text"))
    sizes = []
    stored = enc.store

    def counted(df, path):
        out = stored(df, path)
        sizes.append(out.count())
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(enc, "store", counted)
        out = encode_corpus(many, vocab, plan="dictionary")
    assert max(sizes) <= 64
    want = encode_corpus(many.limit(1), vocab).first().tokens
    assert [r.tokens for r in out.select("tokens").distinct().collect()] == [want] and out.count() == 10000


def test_dictionary_with_repeated_and_null_ids(spark, rank_file):
    vocab = load_rank_vocab(spark, rank_file)
    rows = [("a", 1, "the other"), ("a", 1, "the end x"), (None, None, "the the"), (None, None, None), ("b", 2, None), ("b", 3, "")]
    df = spark.createDataFrame(rows, "file string, ord long, text string")
    out = {(r.file, r.ord): r.tokens for r in encode_corpus(df, vocab, plan="dictionary").collect()}
    one = lambda text: list(vocab.encoder()(text))
    pair = sorted([one(" other"), one(" end")])
    assert out == {
        ("a", 1): one("the") * 2 + pair[0] + pair[1] + one(" x"), (None, None): one("the") + one(" the"),
        ("b", 2): [], ("b", 3): [],
    }


def test_a_batch_is_encoded_in_small_parts(spark, rank_file):
    """No more than a few hundred texts of a batch are Python objects at once."""
    udf = enc._encode_udf(load_rank_vocab(spark, rank_file))
    parts = list(udf.func(iter([pa.array(["the end"] * 1000 + [None])])))
    assert max(len(p) for p in parts) <= 256 and sum(len(p) for p in parts) == 1001
    assert parts[-1][-1].as_py() == []
