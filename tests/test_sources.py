import gzip
import json
import os

import pytest
import zstandard

from ctxloom.sources.documents import check_records, read_documents, read_lines, split_bad_records
from ctxloom.sources.listing import dataset_size, list_corpus
from ctxloom.sources.manifest import read_manifest
from ctxloom.sources.paths import common_parent, literal, relative_name
from ctxloom.sources.ranks import read_ranks

from conftest import rank_lines


def lines(*texts):
    return "".join(json.dumps({"text": t, "k": 1}) + "\n" for t in texts).encode()


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "in dé+1"
    (root / "sub").mkdir(parents=True)
    (root / "a.jsonl").write_bytes(lines("a0", "a1"))
    (root / "b.jsonl.gz").write_bytes(gzip.compress(lines("b0")) + gzip.compress(lines("b1")))
    z = zstandard.ZstdCompressor()
    (root / "sub" / "c.jsonl.zst").write_bytes(z.compress(lines("c0")) + z.compress(lines("c1")))
    (root / "sub" / "d.jsonl.zstd").write_bytes(z.compress(lines("d0")))
    (root / "e.jsonl").write_bytes(b"")
    (root / "note.txt").write_bytes(lines("extra"))
    (root / "_hidden.jsonl").write_bytes(lines("hidden"))
    return root


def names(df):
    return sorted(r.file.rsplit("/", 1)[-1] for r in df.select("file").distinct().collect())


def test_listing(spark, corpus):
    got = list_corpus(spark, str(corpus))
    assert names(got) == ["a.jsonl", "b.jsonl.gz", "c.jsonl.zst", "d.jsonl.zstd", "e.jsonl"]
    sizes = {r.file: r.bytes for r in got.collect()}
    assert sizes[str(corpus / "a.jsonl")] == (corpus / "a.jsonl").stat().st_size
    assert sizes[str(corpus / "e.jsonl")] == 0
    assert names(list_corpus(spark, str(corpus), ext=".txt")) == ["note.txt"]


def test_explicit_repeated_and_nested_inputs(spark, corpus):
    note = str(corpus / "note.txt")
    assert names(list_corpus(spark, [note])) == ["note.txt"]
    paths = [str(corpus), str(corpus), "file://" + str(corpus / "sub"), str(corpus / "a.jsonl"), note]
    got = list_corpus(spark, paths)
    assert got.count() == 6
    texts = sorted(r.text for r in read_documents(spark, paths).collect())
    assert texts == ["a0", "a1", "b0", "b1", "c0", "c1", "d0", "extra"]
    with pytest.raises(ValueError, match="hidden"):
        list_corpus(spark, [str(corpus / "_hidden.jsonl")])


def test_documents_join_listing(spark, corpus):
    docs = read_documents(spark, str(corpus))
    joined = docs.join(list_corpus(spark, str(corpus)), "file")
    assert joined.count() == docs.count() == 7


def test_order_in_split_file(spark, tmp_path):
    texts = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "big.jsonl").write_bytes(lines(*texts))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_documents(spark, str(tmp_path)).orderBy("block", "ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({r.block for r in rows}) > 3
    assert [r.text for r in rows] == texts


BAD = [
    b"{bad", b"", b'{"no":"t"}', b'{"text":null}', b'{"text":5}', b"[1]", b'{"text":"a"} x', b'{"text":"a"}] [',
    b'{"text":"a"},{"text":"b"}', b'{"text":"a"}} x', b'{"text":"\xff"}', b"{'text':'a'}",
]


def test_records(spark, tmp_path):
    good = [b'{"text":"ok","x":1}', b'{"text":"crlf"}\r', b' {"text":"sp"} ', b'{"text":"a","text":"last"}', b'{"text":"}]"}']
    (tmp_path / "r.jsonl").write_bytes(b"\n".join(good + BAD) + b"\n")
    kept, rejects = split_bad_records(read_lines(spark, str(tmp_path)))
    assert [r.text for r in kept.orderBy("ord").collect()] == ["ok", "crlf", "sp", "last", "}]"]
    reasons = [r.reason for r in rejects.orderBy("ord").collect()]
    assert len(reasons) == len(BAD)
    assert reasons[:6] == [
        "not a JSON object", "blank", "missing text", "null text", "text is not a string", "not a JSON object",
    ]
    assert read_documents(spark, str(tmp_path), on_bad_record="drop").count() == 5
    with pytest.raises(Exception, match="bad record"):
        read_documents(spark, str(tmp_path)).collect()
    for narrow in (lambda d: d.count(), lambda d: d.select("file").collect()):
        with pytest.raises(Exception, match="bad record"):
            narrow(read_documents(spark, str(tmp_path)))
    assert check_records(read_lines(spark, str(tmp_path))).filter("(text is null) = (reason is null)").count() == 0


@pytest.mark.parametrize("name,other", [("a[1].jsonl", "a1.jsonl"), ("a{b,c}.jsonl", "ab.jsonl"), ("a*.jsonl", "ax.jsonl"), ("a?.jsonl", "ay.jsonl")])
def test_names_are_no_patterns(spark, tmp_path, name, other):
    folder = tmp_path / "in[1]"
    for root in (folder, tmp_path / "in1"):
        root.mkdir()
        (root / name).write_bytes(lines("meant"))
        (root / other).write_bytes(lines("other"))
    assert [r.text for r in read_documents(spark, str(folder / name)).collect()] == ["meant"]
    assert names(list_corpus(spark, str(folder / name))) == [name]
    found = read_documents(spark, str(folder))
    assert names(found) == names(list_corpus(spark, str(folder))) == sorted([name, other])
    assert found.count() == 2
    assert dataset_size(spark, str(folder)).first().size == sum(f.stat().st_size for f in folder.iterdir())


def test_text_projection_is_pruned(spark, corpus):
    plan = read_documents(spark, str(corpus))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_ranks(spark, tmp_path):
    (tmp_path / "r").write_text(rank_lines(["th"]))
    got = {bytes(r.token): r["rank"] for r in read_ranks(spark, str(tmp_path / "r")).collect()}
    assert got[b"th"] == 256 and got[b" "] == 32 and len(got) == 257


def test_manifest_and_size(spark, tmp_path):
    (tmp_path / "manifest.jsonl").write_text('{"num_sequences":4,"shard":"shard_00000000"}\n{"num_sequences":2,"shard":"shard_00000001"}')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.bin").write_bytes(b"12345")
    assert [tuple(r) for r in read_manifest(spark, str(tmp_path)).orderBy("shard").collect()] == [
        ("shard_00000000", 4), ("shard_00000001", 2),
    ]
    want = 5 + (tmp_path / "manifest.jsonl").stat().st_size
    assert dataset_size(spark, str(tmp_path)).first()[0] == want


def test_relative_name(spark):
    df = spark.createDataFrame([("/a/b/x",), ("/a/c/y",)], "file string")
    for dirs, files, want in [
        (["/a"], [], ["b/x", "c/y"]),
        (["/a/b"], ["/a/c/y"], ["b/x", "c/y"]),
        ([], ["/a/b/x", "/a/c/y"], ["b/x", "c/y"]),
    ]:
        got = [r[0] for r in df.select(relative_name("file", common_parent(dirs, files))).collect()]
        assert got == want
    assert common_parent([], ["/a/b/x"]) == "/a/b"
    assert common_parent(["s3a://p/x", "s3a://q/x"], []) == "s3a:/"
    assert common_parent(["s3a://p/x", "/q/x"], []) == ""


def test_relative_paths(spark, corpus):
    relative = os.path.relpath(corpus)
    assert list_corpus(spark, relative).exceptAll(list_corpus(spark, str(corpus))).count() == 0


def test_s3_scheme():
    assert literal("s3://bucket/a[1].jsonl") == r"s3a://bucket/a\[1\].jsonl"
    assert literal("s3a://bucket/x") == "s3a://bucket/x"
    assert literal("/data/s3://x") == "/data/s3://x"
