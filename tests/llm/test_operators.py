"""The operators against brute force on small tables, and on nulls, empty and long texts, repeated rows and clashing columns."""

import collections
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ctxloom.llm import bpe, chat, decontaminate, langid, line_dedup, pii, simhash, suffix_dedup, token_count, weighted_sampling
from ctxloom.llm.common import bucketed_by_block
from ctxloom.llm.components import connected_components
from ctxloom.llm.queries import llm_queries
from ctxloom.llm.sql import llm_sql
from ctxloom.llm.vocabularies import pretoken_pattern, read_ranks, vocabulary_path, vocabulary_text

from compare import oracle_connection, run_oracle, run_spark

RANKS = read_ranks("byte_bpe_50k.tiktoken")


def word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named as the operators' own."""
    rng = random.Random(1)
    long_line = " ".join(word(rng) for _ in range(120))
    rows = [(i, " ".join(word(rng) for _ in range(rng.randint(1, 80)))) for i in range(40)]
    rows += [(100 + i, f"{long_line}\n{word(rng)}") for i in range(4)] + [(200, f"{long_line[:50]}Z{long_line[51:]}")]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "é中\U0001f600 ### </turn>"), (None, "no id at all"), (None, None)]
    rows += [(304, "same row"), (304, "same row"), (304, "other text"), (305, "ab " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("score", "fp", "component_id", "line", "d1", "h1", "_row", "ids", "block", "n_chars"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs.cache()


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def key(x):
    return repr(x)


@pytest.mark.parametrize("name", llm_sql())
def test_sql(spark, sf, name):
    assert run_spark(spark, llm_queries()[name], sf) == run_oracle(oracle_connection(sf), llm_sql()[name])


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{k}" for k in range(1, 14)]


# ---------------------------------------------------------------- 1


def test_forward_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate([b"a", b"b", b" ", b" a", b"ab", b" ab"])}
    log_p = np.log(np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.1], [0.1, 0.3], [0.1, 0.1], [0.2, 0.2]]))

    def brute(data, k):
        return 1.0 if not data else sum(np.exp(log_p[i, k]) * brute(data[len(p) :], k) for p, i in pieces.items() if data.startswith(p))

    got = np.exp(langid.word_scores(["ab", "abab", "a"], pieces, log_p))
    assert np.allclose(got, [[brute(b" " + w, k) for k in (0, 1)] for w in (b"ab", b"abab", b"a")])


def test_held_out_accuracy_and_odd_rows(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))), RANKS)
    out = langid.identify(docs.filter(langid.held_out(F.col("doc_id"))), model)
    assert out.filter("lang = lang_pred").count() >= 0.95 * out.count()
    found = langid.identify(odd, model)
    assert found.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"] and found.count() == odd.count()
    assert found.filter(r"text is null or not text rlike '\\p{L}'").select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
    assert langid.identify(odd, langid.train(docs.limit(0), RANKS)).select("lang_pred").distinct().collect() == [("und",)]


# ---------------------------------------------------------------- 2


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_line_dedup(spark, odd):
    rng = random.Random(2)
    lines = ["".join(rng.choice("ab") for _ in range(rng.randint(4, 9))) for _ in range(120)]
    docs = spark.createDataFrame([(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(30)], "doc_id long, text string")
    got = {r["_row"]["doc_id"]: r["removed"] for r in line_dedup.mark_lines(docs, 5).collect()}
    earlier = []
    for i in range(30):
        gone = []
        for no, line in enumerate(lines[4 * i : 4 * i + 4]):
            if len(line) >= 5:
                gone += [no] * any(near(line, e) for e in earlier)
                earlier.append(line)
        assert got[i] == gone
    marked = line_dedup.mark_lines(odd).collect()
    assert len(marked) == odd.count() and sum(bool(r["removed"]) for r in marked) == 4
    assert all(r["kept"] is None and r["n_lines"] == 0 for r in marked if r["_row"]["text"] is None)
    kept = line_dedup.without_repeated_lines(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert line_dedup.without_repeated_lines(odd.limit(0)).count() == 0


def test_short_lines_that_repeat_go(spark):
    rows = [(1, "Les.\n\n \u3000\nabc\n日本"), (2, "Les.\n\n \u3000\nabd"), (3, "日本\nLes.\nLes"), (4, "Les.\nabc"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_row"]["doc_id"]: r["removed"] for r in line_dedup.mark_lines(docs).collect()}
    assert got == {1: [], 2: [0], 3: [0, 1], 4: [0, 1], 5: [], 6: []}  # blank lines stay, and one edit is not looked for in short lines
    kept = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(docs, None).collect()}
    assert kept == {1: rows[0][1], 2: "\n \u3000\nabd", 3: "Les", 5: None, 6: ""}


# ---------------------------------------------------------------- 3


def test_branches(spark):
    #  1 - 2 - 3 (5)    and a second tree without an id; the third node's reply is missing its parent
    rows = [("t", 1, None, 1.0, "user", "a: ###"), ("t", 2, 1, 1.0, "x: y", None), ("t", 3, 2, 5.0, "assistant", "b </turn>\n\\"),
            ("t", 4, 1, 2.0, "assistant", "c"), (None, 1, None, None, None, "alone"), ("u", 7, 99, 1.0, "assistant", "####")]
    nodes = spark.createDataFrame(rows, "conv string, node long, parent long, score double, role string, text string")
    out = {(r["conv"], r["rank"]): r for r in chat.read_back(chat.format_branches(nodes, best=2)).collect()}
    assert set(out) == {("t", 1), ("t", 2), (None, 1), ("u", 1)}
    assert [tuple(t) for t in out["t", 1]["turns"]] == [("user", "a: ###"), ("x: y", ""), ("assistant", "b </turn>\n\\")]
    assert out["t", 1]["loss_text"] == "b </turn>\n\\" and out["t", 1]["formatted"].count("</turn>\n") == 3
    assert [tuple(t) for t in out["t", 2]["turns"]] == [("user", "a: ###"), ("assistant", "c")]
    assert out["u", 1]["loss_text"] == "####" and "###" not in out["u", 1]["formatted"][4:]
    mark = out["t", 1]["loss"][0]
    assert out["t", 1]["formatted"][mark["start"] :][: mark["length"]] == "b <\\/turn>\n\\\\"
    assert chat.format_branches(nodes.limit(0)).count() == 0
    circle = spark.createDataFrame([("c", 1, 2, 1.0), ("c", 2, 1, 1.0)], "conv string, node long, parent long, score double")
    with pytest.raises(ValueError):
        chat.branch_paths(circle)


# ---------------------------------------------------------------- 4


def test_golay_keys_meet():
    golay, rng = simhash.GolayKeys(), np.random.default_rng(3)
    for _ in range(400):
        one = rng.integers(0, 2**64, 1, dtype=np.uint64)
        other = one.copy()
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            other ^= np.uint64(1) << np.uint64(bit)
        assert set(golay.keys(one)[1]) & set(golay.keys(other)[1])


def components(n, linked):
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_spanning_links_keep_all_components():
    rng = np.random.default_rng(4)
    for _ in range(60):
        seeds = rng.integers(0, 2**64, 3, dtype=np.uint64)
        members = list(seeds)
        for _ in range(40):
            x = members[rng.integers(len(members))]
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                x = x ^ (np.uint64(1) << np.uint64(bit))
            members.append(x)
        members = np.unique(np.array(members, np.uint64))
        links = {frozenset(x) for x in simhash.spanning_links(members)}
        want = components(len(members), lambda i, j: np.bitwise_count(members[i] ^ members[j]) <= 4)
        assert components(len(members), lambda i, j: frozenset((i, j)) in links) == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(300 + i, 301 + i) for i in range(40)] + [(7, None)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = {frozenset(e) for e in edges if None not in e}
    want = components(341, lambda i, j: frozenset((i, j)) in real)
    assert got == {n: want[n] for e in real if len(e) > 1 for n in e}


def test_simhash(spark, sf, odd):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd):
        out = simhash.simhash_components(docs).collect()
        fps = np.array([simhash.fingerprint(t) for _, t in pairs(docs)], np.uint64)
        assert sorted(fps.view(np.int64).tolist()) == sorted(r["fp"] for r in out)
        own = np.array([r["fp"] for r in out]).view(np.uint64)
        ids = [r["doc_id"] for r in out]
        root = components(len(out), lambda i, j: np.bitwise_count(own[i] ^ own[j]) <= 4)
        least = collections.defaultdict(list)
        for r, i in zip(root, ids):
            least[r] += [i] * (i is not None)
        assert [r["component_id"] for r in out] == [min(least[r], default=None) for r in root]
    assert simhash.fingerprint("") == 0 and simhash.near_duplicates_removed(odd).columns == odd.columns
    assert simhash.simhash_components(odd.limit(0)).count() == 0


# ---------------------------------------------------------------- 5


def test_personal_data(spark, odd):
    weights = pii.fit(pii.made_examples())
    text = "x a.b@c.de.f 1.2.3.4.5 300.1.1.1 or 4111 1111 1111 1111, +1 (988) 555-2485 and (988) 555-2485 é"
    found = pii.all_spans(text, weights)
    assert [(text[a:b], k) for a, b, k, base in found if base] == [
        ("a.b@c.de.f", "email"), ("1.2.3.4", "ip"), ("4111 1111 1111 1111", "card"), ("+1 (988) 555-2485", "phone")]
    assert ("(988) 555-2485", "phone") in [(text[a:b], k) for a, b, k, base in found if not base]
    fresh = pii.made_examples(200, seed=11)
    right = sum([(a, b, k) for a, b, k, _ in pii.all_spans(t, weights)] == spans for t, spans in fresh)
    assert right >= 190
    assert pii.base_spans("a" * 100_000 + "@" * 1000 + "1" * 5000) == []
    out = pii.find_personal_data(odd, weights)
    assert out.count() == odd.count() and out.filter("size(spans) > 0").count() == 0
    assert pii.find_personal_data(odd.limit(0), pii.train(odd.limit(0))).count() == 0


def test_long_numeric_text_is_scored_in_slices(monkeypatch):
    weights = pii.fit(pii.made_examples())
    rng = random.Random(13)
    forms = [lambda: str(rng.randrange(10**6)), lambda: f"{rng.randrange(100, 999)}-555-{rng.randrange(1000, 9999)}", lambda: "ab [at] cd.com"]
    text = " ".join(rng.choice(forms)() for _ in range(150))
    whole = pii.all_spans(text, weights)
    monkeypatch.setattr(pii, "_SLICE", 20)
    assert pii.all_spans(text, weights) == whole and len(whole) > 20
    monkeypatch.undo()
    # Several MB in one region; of features only their number matters here.
    sizes, scores = [], pii._scores
    monkeypatch.setattr(pii, "_scores", lambda region, w: sizes.append(len(region.segments)) or scores(region, w))
    monkeypatch.setattr(pii, "span_features", lambda text, start, end: [0] * 17)
    pii.all_spans("123 456 " * 250_000, weights)
    assert sum(sizes) > 3_000_000 and max(sizes) <= pii.MAX_ATOMS * 2000


# ---------------------------------------------------------------- 6


def test_search_finds_every_window():
    rng = random.Random(6)
    for length in (1, 2, 3, 10):
        words = [rng.choice([b"a", b"b"]) for _ in range(3000)]
        patterns = {tuple(rng.choice([b"a", b"b"]) for _ in range(length)): frozenset("x") for _ in range(5)}
        got = [s for s, _ in decontaminate.WuManber(patterns, length).find(words)]
        assert got == [i for i in range(len(words) - length + 1) if tuple(words[i : i + length]) in patterns]


def test_blocks_of_patterns_give_the_same(spark, sf, odd):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = items.select("item_id", "text").unionByName(spark.createDataFrame([(None, None), (5, "same ROW"), (6, "")], "item_id long, text string"))
    for table in (docs, odd):
        whole, cut = (sorted(map(tuple, decontaminate.find_contamination(table, items, block_bytes=n).collect()), key=key) for n in (1 << 24, 2000))
        assert whole == cut and len(whole) == table.count()
    assert decontaminate.drop_contaminated(odd, items).count() == odd.count() - 2
    assert decontaminate.drop_contaminated(odd, items.limit(0)).columns == odd.columns


# ---------------------------------------------------------------- 7 and 9

ODD_CHARS = "abcXYZ 's't'RE \t\n\x0b\x0c\r\x1c\x85\xa0 ​　0123½²Ⅷ!?#ΣΑ İıßẞé中文日本한글<|endoftext|>_-١٢\U0001f600\x00"


def test_token_counts(spark, odd):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ODD_CHARS) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["a<|endoftext|>b<|startoftext|>", "x" * 3000, "ΟΔΟΣ ΣΑΣ", "thethe" * 500]
    counter = token_count.TokenCounter(vocabulary_text("word_bpe_49k.json"))
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    out = token_count.count_tokens(odd, vocabulary_text("word_bpe_49k.json")).collect()
    want = [(i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in pairs(odd)]
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_bpe_round_trip(spark, odd):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(ODD_CHARS) for _ in range(rng.randint(0, 60)))) for i in range(500)] + [(900, "a" * 20000)]
    library = tiktoken.Encoding("own", pat_str=pretoken_pattern(), mergeable_ranks=RANKS, special_tokens={})
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), odd, odd.limit(0)):
        out = bpe.decode_documents(bpe.encode_documents(docs, RANKS, pretoken_pattern(), 5000), RANKS).collect()
        want = [(i, library.encode_ordinary(t), t.encode()) for i, t in pairs(docs)]
        assert sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in out), key=key) == sorted(want, key=key)


# ---------------------------------------------------------------- 8


def test_repeats(spark, sf, odd):
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))
    for docs in (spark.read.parquet(f"{sf}/documents.parquet").repartition(3), odd, odd.limit(0)):
        texts = [(i, t.encode()) for i, t in pairs(docs)]
        seen = collections.Counter(t[k : k + 200] for _, t in texts for k in range(len(t) - 199))
        want = []
        for i, t in texts:
            mask = np.zeros(len(t), bool)
            for k in range(len(t) - 199):
                if seen[t[k : k + 200]] > 1:
                    mask[k : k + 200] = True
            want.append((i, len(t), int(mask.sum()), np.frombuffer(t, np.uint8)[~mask].tobytes()))
        out = suffix_dedup.remove_repeats(docs, 50_000).collect()
        got = [(r["doc_id"], r["n_bytes"], sum(b - a for a, b in r["removed"]), bytes(r["kept"])) for r in out]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_blocks_keep_their_names_when_tasks_run_again(spark, odd, monkeypatch):
    shuffled = []
    monkeypatch.setattr(suffix_dedup, "bucketed_by_block", lambda rows: shuffled.append(rows) or bucketed_by_block(rows))
    suffix_dedup.remove_repeats(odd, 2000)
    first, again = (sorted(r["block"] for r in shuffled[0].select("block").collect()) for _ in range(2))
    assert first == again and len(first) > 3


# ---------------------------------------------------------------- 10


def jaccard(one, other):
    a, b = (collections.Counter(t.lower().split()) for t in (one, other))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_weighted_sampling(spark, odd):
    rng = random.Random(9)
    rows = [(i, " ".join(word(rng) for _ in range(200))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near_edited = weighted_sampling.likeness("signature", "edited_signature").alias("near")
    out = {r["doc_id"]: r for r in weighted_sampling.compare_with_edits(docs).select("*", near_edited).collect()}
    errors = []
    for i, text in rows:
        half, after = len(text) // 2, rows[i - 1][1]
        edited = text[: len(text) - half] + after[:half]
        assert out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i]["next_signature"] == out[(i - 1) % 300]["signature"]
        errors.append(out[i]["near"] - jaccard(text, edited))
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.15
    got = weighted_sampling.compare_with_edits(odd).collect()
    assert len(got) == len({(r[0], r[1] or "") for r in pairs(odd)})
    assert weighted_sampling.compare_with_edits(odd.limit(0)).count() == 0
    equal = weighted_sampling.fingerprint_texts(spark.createDataFrame([(1, "b A a"), (2, "a b a"), (3, ""), (4, None)], "doc_id long, text string"))
    s = {r["doc_id"]: r["signature"] for r in equal.collect()}
    assert s[1] == s[2] and s[3] == s[4] != s[1]


def test_likeness_is_close_to_the_true_one(spark):
    rng = random.Random(12)
    rows = []
    for i in range(240):
        words = [word(rng) for _ in range(150)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(w if rng.random() < 0.85 else word(rng) for w in words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = weighted_sampling.compare_with_edits(docs).select("doc_id", weighted_sampling.likeness("signature", "next_signature").alias("near"))
    near_next = {r["doc_id"]: r["near"] for r in out.collect()}
    errors = [near_next[2 * i + 1] - jaccard(rows[2 * i + 1][1], rows[2 * i][1]) for i in range(240)]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
