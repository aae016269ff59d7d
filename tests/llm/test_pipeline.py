"""The pipeline's stages one after another, each against its own input."""

import corpus_pipeline as pipeline
from connscore.llm import common as C

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = C.table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    ids = {r.doc_id for r in docs.collect()}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        docs = C.written(stage(spark, docs, SF), f"test-{i}")
        if i < len(pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            now = docs.count()
            assert 0 < now <= before, name
            before = now
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids
    assert "sequence_id" in docs.columns
    whole = pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_stages_on_an_empty_table(spark):
    docs = C.table(spark, SF, "documents").limit(0)
    for i, (_, stage) in enumerate(pipeline.STAGES):
        docs = C.written(stage(spark, docs, SF), f"empty-{i}")
        assert docs.count() == 0


def test_dedup_stages_keep_the_same_rows_of_frames_without_files(spark):
    docs = C.table(spark, SF, "documents")
    memory = spark.createDataFrame(docs.collect(), docs.schema)
    union = docs.filter("doc_id % 2 = 0").unionByName(docs.filter("doc_id % 2 = 1"))
    for _, stage in pipeline.STAGES[1:3]:
        want = sorted(r.doc_id for r in stage(spark, docs, SF).collect())
        assert 0 < len(want) < docs.count()
        for df in (memory, union):
            out = stage(spark, df, SF)
            assert out.columns == docs.columns
            assert sorted(r.doc_id for r in out.collect()) == want
