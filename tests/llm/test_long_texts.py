"""Texts and lines of a megabyte: the operators' time may not grow with the square of their length."""

import random
import re
import time

from ctxloom.llm import line_dedup, pii


def test_addresses_are_those_of_the_plain_pattern():
    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice("125...a ") for _ in range(rng.randint(1, 40)))
        assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_a_megabyte_of_digits():
    weights = pii.fit(pii.made_examples())
    begin = time.time()
    assert pii.all_spans("1" * 1_000_000, weights) == []
    assert time.time() - begin < 30


def test_disguised_ending_is_a_feature():
    """The feature of an ending holds for each way to write its dot."""
    wanted = pii.hash_name("end True 1")
    for dot in (".", "(dot)", "[dot]"):
        text = f"jo@mail{dot}org"
        assert wanted in pii.span_features(text, 0, len(text))
    assert wanted not in pii.span_features("jo@mail-org", 0, 11)


def test_variant_hashes_are_those_of_the_variants():
    rng = random.Random(4)
    for _ in range(50):
        line = "".join(rng.choice("aab\U0001f600中") for _ in range(rng.randint(0, 30)))
        hashes = line_dedup.variant_hashes(line, 9).tolist()
        cut = [line] + [line[:i] + line[i + 1 :] for i in range(len(line))]
        assert hashes == [line_dedup.variant_hashes(v, 9)[0] for v in cut]
        assert len(set(hashes)) == len(set(cut))  # equal variants only have equal hashes


def test_lines_of_a_million_characters_one_edit_apart(spark):
    rng = random.Random(6)
    line = "".join(rng.choice("abcdefgh ") for _ in range(1_000_000))
    rows = [(1, line), (2, f"{line[:400_000]}Z{line[400_001:]}"), (3, f"{line[:700_000]}{line[700_001:]}"), (4, f"{line[:500_000]}ZZ{line[500_001:]}Z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    begin = time.time()
    got = {r["doc_id"]: r["removed"] for r in line_dedup.mark_lines(docs).select("_row.doc_id", "removed").collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: []}
    assert time.time() - begin < 90
