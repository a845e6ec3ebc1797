"""The pipeline's stages against what they must keep, on the small tables and on odd rows."""

import corpus_pipeline
from pyspark.sql import functions as F

from ctxloom.llm import line_dedup, simhash
from ctxloom.llm.queries import op6_decontaminate  # noqa: F401


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        assert name == "tokens" or out.columns == docs.columns
        at[name], docs = out, out
    first = spark.read.parquet(f"{sf}/documents.parquet")
    letters = first.filter(r"text rlike '\\p{L}'")
    assert at["language ID"].count() >= 0.99 * letters.count()
    marked = line_dedup.mark_lines(at["language ID"]).filter("size(removed) < n_lines").select("_row.doc_id", "kept")
    assert marked.exceptAll(at["line dedup"].select("doc_id", "text")).count() == 0
    groups = simhash.simhash_components(at["line dedup"]).select("component_id").distinct()
    assert groups.exceptAll(at["near-dedup"].select("doc_id")).count() == 0 == at["near-dedup"].count() - groups.count()
    assert at["tokens"].select("doc_id", "text").exceptAll(at["decontamination"].select("doc_id", "text")).count() == 0
    assert at["tokens"].count() == at["decontamination"].count() > 0


def test_empty_and_odd_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("ids", F.lit(1))
    odd = spark.createDataFrame([(None, None, None, None, None, 1), (9, "", "en", None, 0, 2), (9, "one text", None, "s", 8, 3)], docs.schema)
    for table in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, sf).cache()
            table.count()
