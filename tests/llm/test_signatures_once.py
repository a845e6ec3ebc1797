"""Drawing samples is most of operator 10's work: a text and its edit are each drawn once."""

from ctxloom.llm import weighted_sampling

SCHEMA = "doc_id long, text string"


def rows_of(n):
    return [(i, " ".join(f"w{(i * 7 + j * j) % 41}" for j in range(3 + i % 29))) for i in range(n)] + [(None, "a b a"), (n, None)]


def test_each_version_of_a_text_is_drawn_once(spark, monkeypatch):
    drawn, sketches = [], weighted_sampling._sketches

    def counted(rows, *rest):
        drawn.append(rows.count())
        return sketches(rows, *rest)

    monkeypatch.setattr(weighted_sampling, "_sketches", counted)
    docs = spark.createDataFrame(rows_of(40), SCHEMA)
    out = weighted_sampling.compare_with_edits(docs, 24).collect()
    assert len(out) == 42 and sum(drawn) == 2 * 42
    # Each document has the signature of its own text, and beside it that of the text that follows.
    by_id = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0), reverse=True)
    assert [r.next_signature for r in by_id] == [r.signature for r in by_id[1:] + by_id[:1]]
    alone = {r.doc_id: r.signature for r in weighted_sampling.fingerprint_texts(docs, 24).collect()}
    assert {r.doc_id: r.signature for r in out} == alone


def test_pieces_are_shuffled_once(spark):
    docs = spark.createDataFrame(rows_of(40), SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = weighted_sampling.compare_with_edits(docs, 8)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line and "REPARTITION_BY_NUM" in line and "Reused" not in line]
    assert len(shuffles) == 3  # texts, pieces, signatures


def test_repeated_rows_change_nothing(spark):
    rows = rows_of(20)
    once = weighted_sampling.compare_with_edits(spark.createDataFrame(rows, SCHEMA), 16)
    often = weighted_sampling.compare_with_edits(spark.createDataFrame(rows * 3, SCHEMA), 16)
    assert sorted(map(str, often.collect())) == sorted(map(str, once.collect()))
