import corpus_pipeline
from lakework.llm import exact, neardup
from tests.llm.conftest import SF, texts


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if name != "packing":
            assert docs.columns == columns
            seen.append(docs.count())
        if name == "exact_dedup":
            assert docs.select("text").distinct().count() == docs.count()
            assert exact.copies(docs).filter("not kept").count() == 0
        if name == "near_dedup":
            assert neardup.classes(docs).filter("class_size > 1").count() == 0
            last = docs
    assert seen == sorted(seen, reverse=True) and 0 < seen[-1] < seen[0]
    assert {r["doc_id"] for r in docs.collect()} == {i for i, _ in texts(last)}


def test_edge_rows(spark, edge, nothing, tmp_path):
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            assert name == "packing" or docs.columns == columns
        docs.collect()
