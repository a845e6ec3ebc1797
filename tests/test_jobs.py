import gzip
import io
import json
import os
import tarfile

import pytest

from ctxloom.__main__ import main
from ctxloom.functions.encoders import encode_bytes
from ctxloom.functions.presets import LLAMA3, NEOX
from ctxloom.operators.encode import load_rank_vocab
from ctxloom.plans.card import finalize_card
from ctxloom.plans.shuffle_only import shuffle_shards
from ctxloom.plans.tokenize_shuffle import tokenize_shuffle
from ctxloom.sinks.shard_tar import write_shards
from ctxloom.sources.listing import dataset_size
from ctxloom.sources.shards import decode_contexts, index_shards, read_ranges, read_shards

FILES = {
    "a.jsonl": ["ab", "cde"],
    "b.jsonl.gz": ["abcdefghij" * 5, "", "x"],
    "sub/c.jsonl": ["é 日本"] * 7,
    "empty.jsonl": [],
}


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    for name, texts in FILES.items():
        data = "".join(json.dumps({"text": t}) + "\n" for t in texts).encode()
        (root / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    return str(root)


def expected(seqlen, pad=50256, bos=None):
    out = []
    for texts in FILES.values():
        stream = [t for text in texts for t in [*([bos] if bos else []), *text.encode(), 0]]
        stream += [pad] * (seqlen - len(stream) % seqlen)
        out += [tuple(stream[i : i + seqlen]) for i in range(0, len(stream), seqlen)]
    return sorted(out)


def written(folder):
    """shard -> [(member, tokens)], read without Spark."""
    out = {}
    for name in sorted(os.listdir(folder)):
        if name.endswith(".tar"):
            with tarfile.open(f"{folder}/{name}") as tar:
                out[name] = [(m.name, tuple(json.loads(gzip.decompress(tar.extractfile(m).read())))) for m in tar]
    return out


def contexts_of(shards):
    return sorted(tokens for members in shards.values() for _, tokens in members)


@pytest.mark.parametrize("shuffle", ["global", "cells"])
@pytest.mark.parametrize("rows_per_block", [None, 2])
def test_tokenize_shuffle(spark, corpus, tmp_path, byte_file, shuffle, rows_per_block):
    out = str(tmp_path / "out")
    vocab = load_rank_vocab(spark, byte_file)
    result = tokenize_shuffle(
        spark, corpus, out, vocab, seqlen=8, chunk_size=4, shuffle=shuffle, n_cells=16, rows_per_block=rows_per_block
    )
    shards = written(out)
    want = expected(8)
    assert contexts_of(shards) == want
    sizes = [len(m) for m in shards.values()]
    assert sizes[:-1] == [4] * (len(sizes) - 1) and len(sizes) == -(-len(want) // 4)
    for i, (name, members) in enumerate(shards.items()):
        assert name == f"shard_{i:08d}.tar"
        assert [m[:17] for m, _ in members] == [f"{i:08d}_{j:08d}" for j in range(len(members))]
        assert all(m.endswith(".json.gz") for m, _ in members)
    with open(f"{out}/manifest.jsonl") as f:
        text = f.read()
    assert not text.endswith("\n")
    assert [json.loads(x) for x in text.split("\n")] == [
        {"shard": f"shard_{i:08d}", "num_sequences": n} for i, n in enumerate(sizes)
    ]
    docs = sum(map(len, FILES.values()))
    assert result.summary["docs"] == docs
    assert result.summary["contexts"] == len(want)
    assert result.summary["token_count"] == len(want) * 8
    assert result.summary["short_shards"] == (1 if len(want) % 4 else 0)


def test_rerun_writes_the_same_bytes(spark, corpus, tmp_path):
    outs = [str(tmp_path / n) for n in ("one", "two")]
    for out, partitions in zip(outs, ("2", "5")):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        tokenize_shuffle(spark, corpus, out, encode_bytes, seqlen=8, chunk_size=5)
        spark.conf.set("spark.sql.shuffle.partitions", old)
    names = sorted(n for n in os.listdir(outs[0]) if not n.startswith("."))
    assert names == sorted(n for n in os.listdir(outs[1]) if not n.startswith("."))
    for name in names:
        with open(f"{outs[0]}/{name}", "rb") as a, open(f"{outs[1]}/{name}", "rb") as b:
            assert a.read() == b.read()


def test_llama3_counts_no_bos(spark, corpus, tmp_path, byte_file):
    out = str(tmp_path / "out")
    vocab = load_rank_vocab(spark, byte_file, "llama3")
    result = tokenize_shuffle(spark, corpus, out, vocab, tokenizer=LLAMA3, seqlen=8, chunk_size=100)
    want = expected(8, pad=128258, bos=128000)
    assert contexts_of(written(out)) == want
    assert result.summary["token_count"] == len(want) * 8 - result.summary["docs"]


@pytest.mark.parametrize("shuffle", ["global", "cells"])
def test_broadcasts_can_be_refused(spark, corpus, tmp_path, monkeypatch, shuffle):
    monkeypatch.setattr("ctxloom.plans.common.BROADCAST_LIMIT", -1)
    out = str(tmp_path / "out")
    tokenize_shuffle(spark, corpus, out, encode_bytes, seqlen=8, chunk_size=4, shuffle=shuffle)
    assert contexts_of(written(out)) == expected(8)


@pytest.mark.parametrize("rows_per_block", [None, 3])
def test_split_files_keep_their_order(spark, tmp_path, rows_per_block):
    """A plain file of several splits beside a compressed one."""
    (tmp_path / "in").mkdir()
    texts = [f"{i} " + "y" * (i % 23) for i in range(400)]
    data = "".join(json.dumps({"text": t}) + "\n" for t in texts).encode()
    (tmp_path / "in" / "p.jsonl").write_bytes(data)
    (tmp_path / "in" / "z.jsonl.gz").write_bytes(gzip.compress(data))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        out = str(tmp_path / "o")
        tokenize_shuffle(
            spark, str(tmp_path / "in"), out, encode_bytes, seqlen=50, chunk_size=100, rows_per_block=rows_per_block
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    stream = [t for text in texts for t in [*text.encode(), 0]]
    stream += [50256] * (50 - len(stream) % 50)
    want = [tuple(stream[i : i + 50]) for i in range(0, len(stream), 50)]
    assert contexts_of(written(out)) == sorted(want * 2)


def test_drop_counts_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text('{"text":"ab"}\n{bad\n\n{"text":"cde"}\n')
    args = (spark, str(tmp_path / "in"))
    result = tokenize_shuffle(*args, str(tmp_path / "o"), encode_bytes, seqlen=8, on_bad_record="drop")
    assert result.rejects == 2
    assert contexts_of(written(str(tmp_path / "o"))) == [(97, 98, 0, 99, 100, 101, 0, 50256)]
    with pytest.raises(Exception, match="bad record"):
        tokenize_shuffle(*args, str(tmp_path / "p"), encode_bytes, seqlen=8)
    assert not os.path.exists(tmp_path / "p" / "manifest.jsonl")


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_bytes(b"")
    (tmp_path / "in" / "b.jsonl.gz").write_bytes(gzip.compress(b""))
    out = str(tmp_path / "o")
    result = tokenize_shuffle(spark, str(tmp_path / "in"), out, encode_bytes, seqlen=4)
    assert contexts_of(written(out)) == [(50256,) * 4] * 2
    assert result.summary["docs"] == 0 and result.summary["token_count"] == 8


def test_output_is_never_mixed(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    tokenize_shuffle(spark, corpus, out, encode_bytes, seqlen=8)
    with pytest.raises(FileExistsError):
        tokenize_shuffle(spark, corpus, out, encode_bytes, seqlen=8)


def test_reader_round_trip(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    tokenize_shuffle(spark, corpus, out, encode_bytes, seqlen=8, chunk_size=4)
    plain = written(out)
    got = decode_contexts(read_shards(spark, out)).orderBy("src", "pos").collect()
    assert [(r.name, tuple(r.tokens)) for r in got] == [m for members in plain.values() for m in members]
    ranges = index_shards(spark, out, range_bytes=2000)
    assert ranges.count() > len(plain)
    again = decode_contexts(read_ranges(ranges)).orderBy("src", "pos").collect()
    assert again == got


@pytest.mark.parametrize("suffix", ["gz", "zst"])
def test_compressed_tar(spark, tmp_path, suffix):
    import zstandard

    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        for i in range(5):
            info = tarfile.TarInfo("n" * 150 + str(i))
            info.size = 3
            tar.addfile(info, io.BytesIO(b"ab%d" % i))
    data = raw.getvalue()
    packed = gzip.compress(data) if suffix == "gz" else zstandard.ZstdCompressor().compress(data)
    (tmp_path / f"t.tar.{suffix}").write_bytes(packed)
    rows = read_shards(spark, str(tmp_path), ext=f"tar.{suffix}").orderBy("pos").collect()
    assert [(r.pos, bytes(r.payload), len(r.name)) for r in rows] == [(i, b"ab%d" % i, 151) for i in range(5)]
    indexed = index_shards(spark, str(tmp_path), ext=f"tar.{suffix}", range_bytes=1)
    assert read_ranges(indexed).count() == 5


@pytest.mark.parametrize("shuffle", ["global", "cells"])
def test_shuffle_only(spark, corpus, tmp_path, shuffle):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    tokenize_shuffle(spark, corpus, first, encode_bytes, seqlen=8, chunk_size=4)
    result = shuffle_shards(spark, first, second, seqlen=8, chunk_size=5, seed=9, shuffle=shuffle, n_cells=16)
    a, b = written(first), written(second)
    assert contexts_of(a) == contexts_of(b)
    assert result.summary["token_count"] == 0
    assert [len(m) for m in b.values()][:-1] == [5] * (len(b) - 1)
    old_names = {n for members in a.values() for n, _ in members}
    new_names = [n for members in b.values() for n, _ in members]
    assert {n[18:] for n in new_names} == old_names
    order = [n[18:] for n in new_names]
    assert order != sorted(order)


def test_sink_rejects_bad_layouts(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", b"x"), (1, "b", b"y"), (0, "c", b"z")], "shard long, name string, payload binary")
    write_shards(df, str(tmp_path / "ok"), ("name",))
    with tarfile.open(tmp_path / "ok" / "shard_00000000.tar") as tar:
        assert tar.getnames() == ["00000000_00000000_a", "00000000_00000001_c"]
    with pytest.raises(Exception, match="not together"):
        df.coalesce(1).write.format("shardtar").mode("append").save(str(tmp_path / "bad"))
    assert not os.path.exists(tmp_path / "bad" / "manifest.jsonl")
    assert not [n for n in os.listdir(tmp_path / "bad") if n.startswith(".shard_")]


CARDS = [
    ({}, {}, 1),
    ({"num_tokens": 3}, {"num_tokens": 3}, 2),
    ({"tokenizer": "mine", "size": 1}, {"tokenizer": "mine", "size": 1}, 0),
    ({"tokenized": False, "other": [1]}, {"tokenized": True, "other": [1]}, 1),
    ({"num_tokens": None, "tokenizer": None}, {"num_tokens": None, "tokenizer": None}, 1),
]


@pytest.mark.parametrize("given,want,n_warnings", CARDS)
def test_card(spark, tmp_path, given, want, n_warnings):
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "manifest.jsonl").write_text('{"num_sequences":10,"shard":"shard_00000000"}')
    card_in, card_out = tmp_path / "in.json", str(tmp_path / "new" / "out.json.gz")
    card_in.write_text(json.dumps(given))
    card, warnings = finalize_card(spark, str(card_in), card_out, str(folder), 8, NEOX)
    with gzip.open(card_out) as f:
        assert json.load(f) == card
    full = {
        "dataset_url": f"{folder}/", "manifest_url": f"{folder}/manifest.jsonl", "tokenized": True, "tokenizer": NEOX,
        "num_tokens": 80, "size": dataset_size(spark, str(folder)).first()[0],
    }
    assert card == {**full, **given, **want}
    assert len(warnings) == n_warnings


def test_no_card_without_both_paths(spark, tmp_path):
    assert finalize_card(spark, None, "x", str(tmp_path), 8, NEOX) == (None, [])


def test_command_line(spark, corpus, tmp_path, byte_file, capsys):
    out, again, card = str(tmp_path / "o"), str(tmp_path / "p"), tmp_path / "card.json"
    card.write_text("{}")
    main(["--input", corpus, "--output", out, "--vocab", byte_file, "--use-tiktoken", "--seqlen", "8",
          "--input-json", str(card), "--output-json", str(tmp_path / "done.json")])
    assert contexts_of(written(out)) == expected(8)
    assert json.loads((tmp_path / "done.json").read_text())["num_tokens"] == 8 * len(expected(8))
    main(["--input", out, "--output", again, "--shuffle-only", "--num-local-cells", "16"])
    assert contexts_of(written(again)) == expected(8)
    assert '"shards": 1' in capsys.readouterr().out


def test_inputs_without_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for job in (
        lambda out: tokenize_shuffle(spark, str(tmp_path / "in"), out, encode_bytes, seqlen=4),
        lambda out: shuffle_shards(spark, str(tmp_path / "in"), out),
    ):
        out = str(tmp_path / f"o{len(os.listdir(tmp_path))}")
        assert job(out).summary["shards"] == 0
        assert "manifest.jsonl" in os.listdir(out)
        assert written(out) == {}
