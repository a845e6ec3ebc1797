"""Manifest, periodic runs and quality rules against brute force, on the small tables and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ctxloom.llm import merkle, quality_rules, runs
from ctxloom.llm.queries import op11_periodic_runs, op12_merkle_manifest, op13_quality_rules

SPACE = r"[^\x20\x09-\x0D]+"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (None, None, None, None, None, "x"), (None, "a b", "en", "s", 3, "x"), (1, "", "en", None, 0, "x"), (1, "", "en", None, 0, "x"),
    (2, "wort " * 400, "de", "s", 5, "x"), (3, "é ß　z", "", "s", None, "x"), (4, "\n\n \t\x0b", "en", "", -1, "x"),
    *[(7, "same row", "fr", "s", 8, "x")] * 40, (2**62, "a b c d e f " * 3000, "en", "s" * 300, 9, "x"),
]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def odd_table(spark, tmp_path, name):
    """The odd rows with columns whose names the operators use themselves."""
    rows = spark.createDataFrame(ODD, COLUMNS + ", digest string")
    for column in ("grp", "rank", "at", "n", "n_words", "kept", "runs", "rule", "path"):
        rows = rows.withColumn(column, F.lit("other"))
    rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (None, 1, 0), (2, None, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    rows.limit(0).write.parquet(f"{tmp_path}/{name}0/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}0/labels.parquet")
    return f"{tmp_path}/{name}"


def checksum(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())


# ---------------------------------------------------------------- manifest


def manifest_by_hand(rows):
    """The whole contract, row by row."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        n = None if r["n_chars"] is None else r["n_chars"] + more
        return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"]))))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def way(tree, at):
        for level in tree[:-1]:
            other = at ^ 1
            yield (level[other] if other < len(level) else None), at & 1
            at >>= 1

    groups = {}
    for r in rows:
        groups.setdefault((b"" if r["lang"] is None else b"=" + r["lang"].encode()), []).append(r)
    trees = {}
    for name, own in groups.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = levels([leaf(r) for r in own])
    names = sorted(trees)
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for name, own in groups.items():
        for at, r in enumerate(own):
            path = [*way(trees[name], at), *way(top, names.index(name))]
            node = leaf(r, int(r["doc_id"] is not None and checksum(r["doc_id"]) % 7 == 0))
            for other, digit in path:
                node = sha((other or "") + node if digit else node + (other or ""))
            proof = sha("".join(o for o, _ in path if o))
            out.append((r["doc_id"], leaf(r), trees[name][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def same_rows(df, want):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def test_manifest_of_odd_rows(spark, tmp_path):
    folder = odd_table(spark, tmp_path, "odd")
    names = [f.split()[0] for f in COLUMNS.split(", ")]
    same_rows(op12_merkle_manifest(spark, folder), manifest_by_hand([dict(zip(names, r[:5], strict=True)) for r in ODD]))
    assert op12_merkle_manifest(spark, folder + "0").collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 33])
def test_small_segments(spark, n):
    """Trees of several segments, proven for every leaf and for a few; equal leaves share their records."""
    rows = spark.range(n).select(F.lit("g").alias("grp"), "id", F.unhex(F.sha2((F.col("id") % 4).cast("string"), 256)).alias("digest"))
    manifest = merkle.build_manifest(rows, ["id"], levels=2)
    nodes = [sha(str(i % 4)) for i in range(n)]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    assert manifest.root.hex() == nodes[0]
    for wanted in (manifest.leaves, manifest.leaves.filter("id % 5 = 2")):
        proofs = merkle.prove(manifest, wanted.select("grp", "rank", "id"))
        got = proofs.select("id", "digest", merkle.fold_path(F.col("digest"), F.col("path")).alias("root")).collect()
        assert sorted(r.id for r in got) == sorted(r.id for r in wanted.collect())
        assert all(r.root.hex() == nodes[0] and r.digest.hex() == sha(str(r.id % 4)) for r in got)


def test_ranks_are_dealt_over_tasks(spark):
    rows = spark.range(1000).select(F.lit("g").alias("grp"), F.lit(1).alias("id"), F.lit(b"x").alias("digest"))
    ranked = merkle.rank_leaves(rows, ["id"])
    assert sorted(r.rank for r in ranked.collect()) == list(range(1000))
    assert ranked.agg(F.max("n")).first()[0] == 1000


# ---------------------------------------------------------------- runs


def runs_by_hand(words, min_length=24, exponent=3):
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, exponent * q) and i > start:
                best.setdefault((start, i + q - start), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in best.items())


def row_of_runs(doc_id, text):
    words = re.findall(SPACE, text or "")
    n, h = len(words), checksum(doc_id)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = (None,) * 4
    if found:
        s, length, q = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_of_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = op11_periodic_runs(spark, sf)
    want = [row_of_runs(*d) for d in docs]
    assert sum(r[1] > 0 for r in want) > 5
    same_rows(got, want)


def test_runs_of_odd_rows(spark, tmp_path):
    folder = odd_table(spark, tmp_path, "odd")
    same_rows(op11_periodic_runs(spark, folder), [row_of_runs(r[0], r[1]) for r in ODD])
    assert op11_periodic_runs(spark, folder + "0").collect() == []


def test_runs_at_random():
    draw = random.Random(3)
    for _ in range(1500):
        size, words = draw.choice([1, 2, 3, 5, 50]), []
        while len(words) < 120:
            kind = draw.random()
            if kind < 0.4:
                unit = [draw.randrange(size) for _ in range(draw.randint(1, 14))]
                words += unit * draw.randint(1, 9) + unit[: draw.randint(0, len(unit))]
            elif kind < 0.6 and words:
                at = draw.randrange(len(words))
                words += words[at : at + draw.randint(1, 60)]
            else:
                words += [draw.randrange(size) for _ in range(draw.randint(1, 9))]
        for bounds in ((24, 3), (3, 3), (10, 4)):
            assert runs.runs_of(runs.word_numbers(words), *bounds) == runs_by_hand(words, *bounds)


def test_runs_of_long_texts():
    """Neither long runs nor many copies take pairwise work."""
    copies = [w for i in range(20000) for w in [10**6 + i, *range(16)]]
    assert runs.runs_of(runs.word_numbers(copies)) == []
    assert runs.runs_of(runs.word_numbers([1] * 300_000)) == [(0, 300_000, 1)]
    assert runs.runs_of(runs.word_numbers([1, 2, 3, 4, 5, 6, 7] * 30_000)) == [(0, 210_000, 7)]


# ---------------------------------------------------------------- rules


def counts_by_hand(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [line for line in text.split("\n") if re.search(SPACE, line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def check_counts(docs, got):
    want = []
    for doc_id, text in docs:
        c = counts_by_hand(text)
        want.append((doc_id, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    same_rows(got.drop("kept", "rule"), want)
    assert got.filter("kept and base_failed").count() == 0


def test_statistics_of_small_table(spark, sf):
    check_counts(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect(), op13_quality_rules(spark, sf))


def test_statistics_of_odd_rows(spark, tmp_path):
    folder = odd_table(spark, tmp_path, "odd")
    check_counts([r[:2] for r in ODD], op13_quality_rules(spark, folder))
    assert op13_quality_rules(spark, folder + "0").collect() == []


def test_rules_on_documents_not_learnt_from(spark, sf):
    """Learnt from the labels of ids not divisible by three, judged on the others."""
    folder = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rules = quality_rules.train(docs, labels.filter("doc_id % 3 <> 0"))
    judged = quality_rules.apply_rules(docs, rules).join(labels.filter("doc_id % 3 = 0"), "doc_id").filter("not base_failed").toPandas()
    good = judged["quality"] == 1
    assert judged.loc[good, "kept"].mean() >= 0.98
    assert (~judged.loc[~good, "kept"]).mean() >= 0.9
    assert str(rules).endswith("else good")


def test_rules_and_expression_agree(spark):
    rng = np.random.default_rng(1)
    values = rng.random((400, len(quality_rules.FEATURES)))
    bad = (values[:, 0] > 0.7) | ((values[:, 1] > 0.5) & (values[:, 2] <= 0.3))
    found = quality_rules.learn(values, bad, np.arange(400) % 3 == 0, 0.8)
    assert len(found.rules) >= 2
    covered = np.any([r.holds(values) for r in found.rules], axis=0)
    assert (covered == bad).mean() > 0.95
    counts = [(i, *map(int, rng.integers(0, 30, len(quality_rules.COUNTS)))) for i in range(200)]
    table = spark.createDataFrame(counts, ["doc_id", *quality_rules.COUNTS])
    columns = [quality_rules.feature(f).alias(f) for f in quality_rules.FEATURES]
    got = table.select("doc_id", found.rule_number().alias("rule"), *columns).orderBy("doc_id").toPandas()
    first = np.zeros(len(got), int)
    for k, rule in reversed(list(enumerate(found.rules, 1))):
        first[rule.holds(got[list(quality_rules.FEATURES)].to_numpy())] = k
    assert (first == got["rule"]).all()


def test_rules_of_nothing():
    none = np.zeros((0, len(quality_rules.FEATURES)))
    assert quality_rules.learn(none, np.zeros(0, bool), np.zeros(0, bool)).rules == ()
    for bad in (True, False):
        assert quality_rules.learn(np.ones((9, len(quality_rules.FEATURES))), np.full(9, bad), np.arange(9) % 3 == 0).rules == ()


def test_repeated_windows():
    draw = random.Random(4)
    for _ in range(500):
        words = [draw.randrange(draw.choice([2, 3, 6])) for _ in range(draw.randint(1, 60))]
        for width in (1, 2, 3, 5, 7):
            windows = Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
            covered = {i + k for i in range(len(words) - width + 1) if windows[tuple(words[i : i + width])] > 1 for k in range(width)}
            assert quality_rules.repeated_words(runs.word_numbers(words), width) == len(covered)
