"""Member counts from a manifest, and what the shuffle-only job reads of its tars."""

import json
import os

import pyarrow as pa
import pytest

from ctxloom.plans.shuffle_only import shuffle_shards
from ctxloom.sinks.shard_tar import write_shards
from ctxloom.sources import shards
from ctxloom.sources.shards import count_shards, index_shards, read_ranges

KEYS = ("src", "first", "start", "end", "members")


@pytest.fixture(scope="module")
def tars(spark, tmp_path_factory):
    """Three tars and their manifest, below a folder with a name to be quoted."""
    out = str(tmp_path_factory.mktemp("tars") / "a b" / "é")
    rows = [(s, f"{i:04}.json.gz", os.urandom(3000)) for s in range(3) for i in range(40)]
    write_shards(spark.createDataFrame(rows, "shard long, name string, payload binary"), out, ("name",))
    return out


def ranges_of(df):
    return sorted(tuple(r[k] for k in KEYS) for r in df.collect())


def copy_with(tars, folder, lines):
    folder.mkdir(parents=True)
    for name in os.listdir(tars):
        if name.endswith(".tar"):
            os.link(os.path.join(tars, name), folder / name)
    (folder / "manifest.jsonl").write_text("\n".join(lines))
    return str(folder)


def line(shard, n):
    return json.dumps({"shard": f"shard_{shard:08}", "num_sequences": n})


def test_counted_tars_are_not_walked(spark, tars):
    """A walked range ends at a byte, so one without an end comes from the manifest."""
    got = ranges_of(count_shards(spark, os.path.dirname(tars)))
    assert got == [(f"{tars}/shard_{s:08}.tar", 0, 0, 0, 40) for s in range(3)]
    assert read_ranges(count_shards(spark, tars)).count() == 120


def test_what_the_manifest_does_not_tell_is_walked(spark, tars, tmp_path):
    want = ranges_of(index_shards(spark, tars))
    lines = {
        "none": [],
        "broken": ["{", "[1]", '{"shard": "shard_00000000"}'],
        "twice": [line(s, n) for s in range(3) for n in (39, 40)],
        "nothing": [line(s, 0) for s in range(3)],
    }
    for name, given in lines.items():
        folder = copy_with(tars, tmp_path / name, given)
        assert [r[1:] for r in ranges_of(count_shards(spark, folder))] == [r[1:] for r in want], name
    assert ranges_of(count_shards(spark, tars, whole_bytes=10)) == want
    assert ranges_of(count_shards(spark, [f"{tars}/shard_{s:08}.tar" for s in range(3)])) == want
    some = copy_with(tars, tmp_path / "some", [line(0, 40), line(9, 7)])
    assert [r[3] == 0 for r in ranges_of(count_shards(spark, some))] == [True, False, False]


@pytest.mark.parametrize("told", [39, 41])
def test_a_wrong_count_stops_the_job(spark, tars, tmp_path, told):
    folder = copy_with(tars, tmp_path / "in", [line(0, 40), line(1, told), line(2, 40)])
    with pytest.raises(Exception, match=f"{told} members were counted and 40 read"):
        shuffle_shards(spark, folder, str(tmp_path / "out"), seqlen=8, chunk_size=50)
    assert not os.path.exists(tmp_path / "out" / "manifest.jsonl")


class _Counted:
    """A raw file that adds up the bytes read of it."""

    def __init__(self, raw):
        self.raw, self.read_bytes = raw, 0

    def __getattr__(self, name):
        return getattr(self.raw, name)

    def readinto(self, buffer):
        n = self.raw.readinto(buffer)
        self.read_bytes += n
        return n


def counted_opens(monkeypatch):
    import io

    opened = []

    def open_bytes(path, read_bytes=4 << 20):
        opened.append(_Counted(io.FileIO(path)))
        return io.BufferedReader(opened[-1], read_bytes)

    monkeypatch.setattr(shards, "open_bytes", open_bytes)
    return opened


def test_bytes_read(tars, monkeypatch):
    """Members are read once; a walk of headers alone reads a fraction of a local tar."""
    src = f"{tars}/shard_00000000.tar"
    size = os.path.getsize(src)
    opened = counted_opens(monkeypatch)
    whole = pa.RecordBatch.from_pylist([dict(zip(KEYS, (src, 0, 0, 0, 40), strict=True))])
    assert sum(b.num_rows for b in shards._read_members(iter([whole]))) == 40
    assert sum(o.read_bytes for o in opened) <= size
    del opened[:]
    names = pa.RecordBatch.from_pylist([{"file": src}])
    (found,) = shards._index_batches(1 << 30)(iter([names]))
    assert found.to_pylist()[0]["members"] == 40
    assert sum(o.read_bytes for o in opened) < 0.8 * size
