import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ctxloom.functions.encoders import byte_count, encode_bytes, encode_word_hash, word_count
from ctxloom.functions.presets import LLAMA3, NEOX, all_presets, preset
from ctxloom.operators.accounting import token_stats
from ctxloom.operators.framing import frame_tokens
from ctxloom.operators.offsets import stream_offsets
from ctxloom.operators.packing import context_spans, pack_contexts
from ctxloom.operators.streams import arrange_blocks, block_streams, block_totals, pack_streams

PAD = 258


def docs_frame(spark, files, start=0, step=1):
    rows = [(f, start + step * i, t) for f, texts in files.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file string, ord long, text string")


def files_frame(spark, files):
    return spark.createDataFrame([(f,) for f in files], "file string")


def plain_pack(files, seqlen, pad=PAD):
    """The contract spelled out in plain Python."""
    out = {}
    for name, texts in files.items():
        stream = [t for text in texts for t in [*text.encode(), 0]]
        stream += [pad] * (seqlen - len(stream) % seqlen)
        for i in range(0, len(stream), seqlen):
            out[name, i // seqlen] = stream[i : i + seqlen]
    return out


def framed(spark, files, rules, **kw):
    df = docs_frame(spark, files, **kw)
    return frame_tokens(df.withColumn("tokens", encode_bytes(F.col("text"))), rules)


def collected(contexts):
    return {(r.file, r.ctx): r.tokens for r in contexts.collect()}


CASES = {
    "short": ({"f": ["ab", "cde"]}, 8),
    "exact": ({"f": ["ab", "cdef"]}, 16),
    "empty_file": ({"f": []}, 8),
    "empty_text": ({"f": [""]}, 8),
    "long": ({"f": ["abcdefghij"]}, 16),
    "two_files": ({"f": ["ab", "cde"], "g": ["abcdefghij"]}, 24),
}


@pytest.mark.parametrize("name", CASES)
def test_worked_cases(spark, byte_rules, name):
    files, token_count = CASES[name]
    df = framed(spark, files, byte_rules)
    got = collected(pack_contexts(df, 8, PAD, files=files_frame(spark, files)))
    assert got == plain_pack(files, 8)
    assert len(got) * 8 == token_count


def test_exact_fill_gives_all_padding(spark, byte_rules):
    got = collected(pack_contexts(framed(spark, {"f": ["ab", "cdef"]}, byte_rules), 8, PAD))
    assert got == {("f", 0): [97, 98, 0, 99, 100, 101, 102, 0], ("f", 1): [PAD] * 8}


def test_llama3_bos_only_on_rank_backend(spark):
    for backend, want, count in [
        ("ranks", [128000, 97, 98, 0] + [128258] * 4, 7),
        ("hf", [97, 98, 0] + [128258] * 5, 8),
    ]:
        rules = preset(LLAMA3, backend)
        df = framed(spark, {"f": ["ab"]}, rules)
        assert collected(pack_contexts(df, 8, rules.pad)) == {("f", 0): want}
        stats = token_stats(df.withColumn("n", F.size("tokens")), rules, 8)
        assert stats.filter("file is null").first().token_count == count


def test_presets():
    assert preset(NEOX, "hf").pad == 50256
    assert preset(LLAMA3, "hf").pad == 128258
    assert len(all_presets()) == 4
    with pytest.raises(ValueError):
        preset("nope")
    with pytest.raises(ValueError):
        preset(NEOX, "nope")


def test_bad_parameters(spark, byte_rules):
    df = framed(spark, {"f": ["a"]}, byte_rules)
    with pytest.raises(ValueError):
        pack_contexts(df, 0, PAD)


def test_length_columns_match_encoders(spark):
    df = spark.createDataFrame([("",), ("a b",), ("  x  é ",), ("日本 語",)], "text string")
    t = F.col("text")
    row = df.select(
        F.bool_and(F.size(encode_bytes(t)) == byte_count(t)), F.bool_and(F.size(encode_word_hash(t)) == word_count(t))
    ).first()
    assert row == (True, True)


@pytest.mark.parametrize("rows_per_range,depth", [(1, 1), (2, 1), (3, 2), (65536, 1), (2, 3)])
def test_offsets_do_not_depend_on_ranges(spark, rows_per_range, depth):
    rows = [(f, b, 7 * i + b * 1000, (i * 13 + b) % 5 + 1) for f in "xy" for b in range(3) for i in range(9)]
    df = spark.createDataFrame(rows, "file string, block long, ord long, n long")
    got = stream_offsets(df, block="block", rows_per_range=rows_per_range, depth=depth)
    at = {}
    for r in sorted(got.collect(), key=lambda r: (r.file, r.block, r.ord)):
        assert r.b == at.get(r.file, 0)
        assert r.e == r.b + r.n
        at[r.file] = r.e


def test_context_spans_cover_documents(spark, byte_rules):
    files = {"f": ["a" * 30, "b", "c" * 9]}
    df = framed(spark, files, byte_rules).withColumn("n", F.size("tokens"))
    spans = context_spans(stream_offsets(df), 8).orderBy("ctx", "offset").collect()
    at = 0
    for s in spans:
        assert s.ctx * 8 + s.offset == at
        at += s.len
    assert at == 31 + 2 + 10


texts = st.text(alphabet="ab é日", max_size=40)
corpora = st.dictionaries(st.sampled_from(["f", "g", "h"]), st.lists(texts, max_size=6), min_size=1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=corpora, seqlen=st.integers(1, 20), step=st.integers(1, 3))
def test_both_packings_keep_the_contract(spark, byte_rules, files, seqlen, step):
    want = plain_pack(files, seqlen)
    names = files_frame(spark, files)
    df = framed(spark, files, byte_rules, step=step)
    packed = pack_contexts(df, seqlen, PAD, files=names)
    assert collected(packed) == want
    assert all(sum(t != PAD for t in r.tokens) == r.n_real for r in packed.collect())

    raw = docs_frame(spark, files, step=step).withColumn("tokens", encode_bytes(F.col("text")))
    streams = block_streams(arrange_blocks(raw, rows_per_block=2), byte_rules, seqlen)
    assert collected(pack_streams(streams, seqlen, PAD, files=names, depth=step - 1)) == want
    docs = {r.file: r.docs for r in block_totals(streams).groupBy("file").agg(F.sum("docs").alias("docs")).collect()}
    assert docs == {f: len(t) for f, t in files.items() if t}


def test_split_block_is_noticed(spark, byte_rules):
    raw = docs_frame(spark, {"f": ["abc"] * 40}).withColumn("tokens", encode_bytes(F.col("text")))
    scattered = raw.withColumn("block", F.lit(0)).repartition(3)
    streams = block_streams(scattered, byte_rules, 8)
    with pytest.raises(Exception, match="block was split"):
        block_totals(streams).collect()


def test_rows_without_a_name_are_an_error(spark, byte_rules):
    df = spark.createDataFrame([("f", 0, 2), (None, 1, 3)], "file string, ord long, n long")
    for made in (stream_offsets(df), stream_offsets(df).select("file"), token_stats(df, byte_rules, 8)):
        with pytest.raises(Exception, match="no stream name"):
            made.collect()
    texts = df.select("file", F.lit(0).cast("bigint").alias("block"), "ord", F.array(F.lit(1)).alias("tokens"))
    with pytest.raises(Exception, match="no stream name"):
        block_streams(texts, byte_rules, 8).collect()
