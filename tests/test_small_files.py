"""Many small files: written without the driver, listed by few tasks, tars read and written header by header."""

import gzip
import io
import json
import tarfile

import pytest

from ctxloom.sinks.line_files import write_line_files
from ctxloom.sinks.shard_tar import member_header
from ctxloom.sources.documents import read_lines
from ctxloom.sources.paths import open_bytes
from ctxloom.sources.shards import _tar_members


def test_line_files_are_whole_and_in_order(spark, tmp_path):
    rows = [(f"no={i % 3}", i, json.dumps({"text": f"é{i}\n"})) for i in range(30)]
    df = spark.createDataFrame(rows, "name string, i int, line string")
    df = df.repartition(4, "name").sortWithinPartitions("name", "i")
    assert write_line_files(df, str(tmp_path / "out"), "part.json.gz") == 3
    for no in range(3):
        (path,) = (tmp_path / "out" / f"no={no}").iterdir()
        with gzip.open(path, "rt") as lines:
            assert lines.read().splitlines() == [line for name, _, line in rows if name == f"no={no}"]


def test_no_lines_leave_an_empty_folder(spark, tmp_path):
    empty = spark.createDataFrame([], "name string, line string")
    assert write_line_files(empty, str(tmp_path / "out"), "part.json.gz") == 0
    assert list((tmp_path / "out").iterdir()) == []


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "a.jsonl").write_text(f"{i}\n")
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual = spark.conf.get(key)
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        lines = read_lines(spark, str(tmp_path), ".jsonl")
        tracker = sc.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) < 300
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(key) == usual
    assert sorted(int(r.line) for r in lines.collect()) == list(range(300))


@pytest.mark.parametrize("name", ["00000000_00000001_a.json.gz", "x" * 100, "x" * 101, "é"])
@pytest.mark.parametrize("size", [0, 1, 512, 700, 8**11 - 1, 8**11])
def test_headers_are_those_of_tarfile(name, size):
    info = tarfile.TarInfo(name)
    info.size, info.mode = size, 0o644
    assert member_header(name, size) == info.tobuf(tarfile.GNU_FORMAT)


def _tar(path, names, form=tarfile.GNU_FORMAT):
    with tarfile.open(path, "w", format=form) as tar:
        for i, name in enumerate(names):
            info = tarfile.TarInfo(name)
            if name.endswith("/"):
                info.type = tarfile.DIRTYPE
            else:
                info.size = 300 * i
            tar.addfile(info, io.BytesIO(bytes([i]) * info.size))


@pytest.mark.parametrize("form", [tarfile.GNU_FORMAT, tarfile.USTAR_FORMAT, tarfile.PAX_FORMAT])
@pytest.mark.parametrize("names", [["a", "b", "c"], ["a", "d/", "b"], ["a", "n" * 60 + "/" + "m" * 90, "b"], ["é", "a"]])
def test_members_are_those_of_tarfile(tmp_path, names, form):
    path = str(tmp_path / "t.tar")
    _tar(path, names, form)
    with tarfile.open(path) as tar:
        want = [(m.offset, m.name, tar.extractfile(m).read() if m.isreg() else b"") for m in tar]
    for payloads in (True, False):
        with open_bytes(path) as stream:
            got = list(_tar_members(stream, True, payloads))
        assert [(at, name) for at, _, name, _ in got] == [w[:2] for w in want]
        assert all(one[1] <= two[0] for one, two in zip(got, got[1:]))
        assert not payloads or [g[3] for g in got] == [w[2] for w in want]


@pytest.mark.parametrize("payloads", [True, False])
def test_a_cut_tar_is_an_error(tmp_path, payloads):
    path = tmp_path / "t.tar"
    _tar(str(path), ["a", "b", "c"])
    path.write_bytes(path.read_bytes()[: 512 + 512 + 512 + 512 + 100])
    with open_bytes(str(path)) as stream, pytest.raises(tarfile.ReadError):
        list(_tar_members(stream, True, payloads))
