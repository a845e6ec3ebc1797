import base64
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ctxloom.functions.presets import Preset  # noqa: E402
from ctxloom.runtime import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ctxloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def byte_rules():
    """The byte vocabulary of the worked cases: id = byte, end id 0, padding 258."""
    return Preset("bytes", "ranks", 256, 0, 258, None, "neox")


MERGES = ["th", "he", " t", "the", " the", "in", "er", "an", "on", " a", "é".encode(), "  "]


def rank_lines(merges=()):
    tokens = [bytes([i]) for i in range(256)] + [m if isinstance(m, bytes) else m.encode() for m in merges]
    return "\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(tokens)) + "\n"


@pytest.fixture(scope="session")
def rank_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("vocab") / "small.ranks"
    path.write_text(rank_lines(MERGES))
    return str(path)


@pytest.fixture(scope="session")
def byte_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("vocab") / "bytes.ranks"
    path.write_text(rank_lines())
    return str(path)
