"""The pipeline on an empty table, and on rows of nulls, ties and clashing columns."""

from pyspark.sql import functions as F

from .conftest import CLASHING, documents, sentence


def _folder(spark, tmp, docs, labels=()):
    docs.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(0, "an item of some words that stands nowhere")], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")


def test_pipeline_of_an_empty_table(spark, tmp):
    import corpus_pipeline as pipeline
    _folder(spark, tmp, documents(spark, []))
    assert pipeline.run(spark, tmp).count() == 0


def test_pipeline_of_odd_rows(spark, rng, tmp):
    import corpus_pipeline as pipeline
    base, other = sentence(rng, 60), sentence(rng, 40)
    rows = [(4, base), (2, base), (2, base), (None, other), (7, None), (8, ""), (9, " \n "), (None, None), (11, "x" * 20_000)]
    docs = documents(spark, rows).withColumns({c: F.lit(c) for c in CLASHING})
    _folder(spark, tmp, docs)
    out = pipeline.run(spark, tmp).collect()
    assert sorted(str(r.doc_id) for r in out if r.piece == 0) == sorted(["2", "None", "7", "8", "9", "None", "11", "4"])
    assert all(r.offset is not None and r.length > 0 for r in out)
