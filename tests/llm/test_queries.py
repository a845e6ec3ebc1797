"""Registered queries without SQL against the libraries and formulas they must equal, row by row."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ctxloom.llm import queries
from ctxloom.llm.vocabularies import pretoken_pattern, read_ranks, vocabulary_path


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_op7_equals_the_library(spark, sf, documents):
    import tokenizers

    tok = tokenizers.Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    got = queries.op7_token_count(spark, sf).collect()
    assert len(got) == len(documents)
    for r in got:
        text = documents[r.doc_id]
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def test_op8_equals_brute_force(spark, sf, documents):
    width = 200
    data = {k: t.encode() for k, t in documents.items()}
    count = {}
    for d in data.values():
        for i in range(len(d) - width + 1):
            key = d[i : i + width]
            count[key] = count.get(key, 0) + 1
    for r in queries.op8_suffix_dedup(spark, sf).collect():
        d = data[r.doc_id]
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if count[d[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(d), sum(gone), spans, sha(kept))


def test_op9_equals_the_library(spark, sf, documents):
    import tiktoken

    bpe = tiktoken.Encoding("b", pat_str=pretoken_pattern(), mergeable_ranks=read_ranks("byte_bpe_50k.tiktoken"), special_tokens={})
    got = queries.op9_bpe(spark, sf).collect()
    assert len(got) == len(documents)
    for r in got:
        ids = bpe.encode(documents[r.doc_id], disallowed_special=())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(documents[r.doc_id]))


def test_op10_likeness_is_near_the_weighted_jaccard(spark, sf, documents):
    from collections import Counter

    order = sorted(documents, reverse=True)
    likely = {}
    for k, doc_id in enumerate(order):
        own, after = documents[doc_id], documents[order[(k + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        a, b, c = (Counter(t.lower().split()) for t in (own, edited, after))

        def jaccard(x, y):
            return sum((x & y).values()) / max(1, sum((x | y).values())) if x or y else 1.0

        likely[doc_id] = (len(own), sha(edited), jaccard(a, b), jaccard(a, c))
    errors = []
    for r in queries.op10_weighted_sampling(spark, sf).collect():
        n, edited, near_edited, near_next = likely[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, edited)
        errors += [r.near_edited - near_edited, r.near_next - near_next]
    assert abs(sum(errors) / len(errors)) < 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.05 and max(map(abs, errors)) < 0.2


def test_op10_samples_do_not_depend_on_what_is_broadcast(spark, sf, monkeypatch):
    from ctxloom.llm import weighted_sampling as ws

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.concat_ws(" ", "text", "text").alias("text"))
    some = sorted(map(str, ws.fingerprint_texts(docs).collect()))
    monkeypatch.setattr(ws, "FREQUENT", 1)
    assert sorted(map(str, ws.fingerprint_texts(docs).collect())) == some


def test_op8_keeps_texts_written_to_collide(spark):
    """Two texts that share no 200 bytes, made so that running sums over fixed numbers take them for equal."""
    from ctxloom.llm.suffix_dedup import remove_repeats

    same = "The committee met on the second day of the month and agreed to keep the record of every case open .."
    ends = [
        "aabaaaaabaaaaaaaaaaaabaabbbaabaabaaaabbaaabaaaaaaabaaaaaaaaaaabaaaaaaabaabbaaaabaaaaaaaaaabaaaaaaabb",
        "baaabbaaaaababbabbabbabbaaabbabbaaabbaaabbaaabababaaabbbbbaabbabbaaabaabaabbaabbaaaabbbaababaaabaabaaaa",
    ]
    rows = spark.createDataFrame([(i, same + e) for i, e in enumerate(ends)], "doc_id long, text string")
    assert all(r.removed == [] and r.kept.decode() == same + ends[r.doc_id] for r in remove_repeats(rows).collect())
    twice = rows.unionByName(rows.filter("doc_id = 0"))
    assert sorted(len(r.kept) for r in remove_repeats(twice).collect())[:2] == [0, 0]
