"""Reruns into the folder of a failed write, and the reject table of the job."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ctxloom.functions.encoders import encode_bytes
from ctxloom.plans.tokenize_shuffle import tokenize_shuffle
from ctxloom.sinks import shard_tar
from ctxloom.sinks.shard_tar import MARKER, write_shards
from ctxloom.sources.documents import check_records, read_lines, split_bad_records


def contents(folder):
    out = {}
    for name in os.listdir(folder):
        if not name.endswith(".crc"):
            with open(f"{folder}/{name}", "rb") as f:
                out[name] = f.read()
    return out


def table(spark, broken=None):
    """Six shards of four contexts; one context of the broken shard is too short."""
    n = F.when((F.col("id") == 4 * broken + 2) if broken is not None else F.lit(False), 3).otherwise(5)
    return spark.range(24).select(
        F.expr("id div 4").alias("shard"), F.format_string("%04d", "id").alias("name"), F.array_repeat(F.col("id").cast("int"), n).alias("tokens")
    )


def test_a_failed_write_is_taken_over(spark, tmp_path):
    out, fresh = str(tmp_path / "out"), str(tmp_path / "fresh")
    with pytest.raises(Exception, match="3 ids, not 5"):
        write_shards(table(spark, 5).coalesce(1), out, shards=6, seqlen=5)
    left = contents(out)
    assert MARKER in left and "manifest.jsonl" not in left
    # Shards with other bytes, one too many, and the remains of a task that was killed.
    for name in ("shard_00000000.tar", "shard_00000099.tar", ".shard_00000003.x.y"):
        with open(f"{out}/{name}", "wb") as f:
            f.write(b"remains")
    write_shards(table(spark), out, shards=6, seqlen=5)
    write_shards(table(spark), fresh, shards=6, seqlen=5)
    assert contents(out) == contents(fresh)
    assert sorted(contents(out)) == ["manifest.jsonl", *[f"shard_{i:08d}.tar" for i in range(6)]]


def test_what_is_not_ours_stays(spark, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    (out / "shard_00000000.tar").write_bytes(b"theirs")
    with pytest.raises(FileExistsError, match="no job of ours"):
        write_shards(table(spark), str(out), seqlen=5)
    assert (out / "shard_00000000.tar").read_bytes() == b"theirs" and len(os.listdir(out)) == 1
    done = str(tmp_path / "done")
    write_shards(table(spark), done, seqlen=5)
    before = contents(done)
    with pytest.raises(FileExistsError, match="already holds"):
        write_shards(table(spark), done, seqlen=5)
    assert contents(done) == before


def test_a_job_that_lost_its_folder_shows_nothing(tmp_path):
    out = str(tmp_path / "out")
    shard_tar.claim(out, "one")
    first = shard_tar._OpenShard(out, 0, "one")
    first.add("a", b"x")
    shard_tar.claim(out, "two")
    with pytest.raises(RuntimeError, match="taken over"):
        first.close()
    assert os.listdir(out) == [MARKER]


def test_object_stores_get_one_write(tmp_path, monkeypatch):
    """Without renames nothing is written under another name, and nothing before a shard's end."""
    monkeypatch.setattr(shard_tar, "_renames", lambda system: False)
    out = str(tmp_path / "out")
    shard_tar.claim(out, "job")
    shard = shard_tar._OpenShard(out, 7, "job")
    shard.add("a", b"x")
    assert os.listdir(out) == [MARKER]
    shard.close()
    assert sorted(os.listdir(out)) == [MARKER, "shard_00000007.tar"]


LINES = {
    "a.jsonl": ['{"text":"ab"}', "{bad", "", '{"text":"cde"}', '{"text":null}', '{"no":1}'],
    "b.jsonl": ["[1]", '{"text":5}'],
    "c.jsonl": ['{"text":"\\ud83d\\ude00 \\\\ud83d"}', '{"text":"x \\ud83d"}', '{"text":"\\ude00\\ud83d"}', '{"text":"y","z":"\\udfff"}'],
}


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "in").mkdir()
    for name, lines in LINES.items():
        (tmp_path / "in" / name).write_text("".join(line + "\n" for line in lines))
    return str(tmp_path / "in")


@pytest.mark.parametrize("rows_per_block", [None, 2])
def test_reject_table(spark, corpus, tmp_path, rows_per_block):
    result = tokenize_shuffle(spark, corpus, str(tmp_path / "o"), encode_bytes, seqlen=64, on_bad_record="drop", rows_per_block=rows_per_block)
    rejects = spark.read.parquet(f"{result.work}/rejects")
    _, want = split_bad_records(read_lines(spark, corpus))
    want = want.withColumn("file", F.regexp_extract("file", r"[^/]+$", 0))
    assert rejects.columns == ["file", "block", "ord", "reason"]
    assert sorted(map(tuple, rejects.collect())) == sorted(map(tuple, want.collect()))
    assert result.rejects == rejects.count() == 9 and result.summary["docs"] == 3
    assert result.summary["contexts"] == 3  # a file of rejects alone is padding


def test_half_characters_are_rejected(spark, corpus):
    checked = check_records(read_lines(spark, corpus)).filter(F.col("file").endswith("c.jsonl")).orderBy("ord").collect()
    assert [(r.text, r.reason) for r in checked] == [
        ("\U0001f600 \\ud83d", None), (None, "half a character"), (None, "half a character"), (None, "half a character"),
    ]


def test_a_line_is_parsed_once(spark, corpus):
    """Neither a filter nor a projection of checked records repeats the parse."""
    checked = check_records(read_lines(spark, corpus))
    for df in (checked.filter("reason is null").select("text"), checked.select("file", "reason"), checked):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField(r") <= 1 and plan.count("from_json(ArrayType") <= 1 and "from_json" in plan


def test_rejects_of_a_failed_job_name_the_record(spark, corpus, tmp_path):
    with pytest.raises(Exception, match="bad record in .*jsonl"):
        tokenize_shuffle(spark, corpus, str(tmp_path / "o"), encode_bytes, seqlen=8)
    assert json.dumps(os.listdir(tmp_path)) and not os.path.exists(tmp_path / "o" / "manifest.jsonl")
