"""The pipeline and the registry."""

from __future__ import annotations

import corpus_pipeline
from chronofold.llm.queries import ORACLES, QUERIES
from tests.llm import cases

FOLDER = "/root/testdata/sf0.001"


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and set(QUERIES) <= set(__spark_entry__.queries())


def test_stages_keep_columns_and_pass_on_what_they_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{n}")
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            docs = spark.read.parquet(f"{tmp_path}/{n}")
            assert docs.count() <= before
            before = docs.count()
    packed = spark.read.parquet(f"{tmp_path}/{n}")
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.count() == packed.count()


def test_stages_on_odd_rows(spark):
    df = cases.frame(spark, repeated=True, null_id=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and 0 < out.count() <= df.count()
        assert stage(spark, cases.empty(spark), "").count() == 0
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").count() == 0
    assert [r["text"].split()[0] for r in kept.filter("doc_id is null").collect()] == ["only"]  # the other one's text has an id elsewhere
