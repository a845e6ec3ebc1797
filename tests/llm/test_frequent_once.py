"""What goes to every task by way of the driver is made and sent once."""

from ctxloom.llm import weighted_sampling


def test_frequent_terms_are_drawn_once(spark, monkeypatch):
    made, drawn = [], weighted_sampling._frequent

    def counted(keyed, samples):
        made.append(samples)
        return drawn(keyed, samples)

    monkeypatch.setattr(weighted_sampling, "_frequent", counted)
    docs = spark.createDataFrame([(i, "a a a b b " * (1 + i % 3)) for i in range(60)], "doc_id long, text string")
    out = weighted_sampling.compare_with_edits(docs, 32)
    assert len(made) == 1
    alone = {r.doc_id: r.signature for r in weighted_sampling.fingerprint_texts(docs, 32).collect()}
    assert {r.doc_id: r.signature for r in out.collect()} == alone
