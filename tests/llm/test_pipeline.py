"""The pipeline's stages on the smallest tables: each keeps what it should and returns the columns
of documents."""

import corpus_pipeline as pipeline
from effort_analytics.llm import minhash_dedup


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, rows = docs, {}
    for name, stage in pipeline.STAGES:
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows[name] = after
        if name != pipeline.STAGES[-1][0]:
            assert after.columns == list(pipeline.COLUMNS)
        assert after.join(before, "doc_id", "left_anti").count() == 0
        before = after
    groups = minhash_dedup.near_duplicates(rows["toxicity"])
    assert {r.doc_id for r in groups.where("kept").collect()} == {r.doc_id for r in rows["near_dedup"].collect()}
    assert rows["pii"].count() == rows["near_dedup"].count()
    assert rows["sentencepiece"].count() == rows["mixing"].count() and rows["sentencepiece"].where("NOT exact").count() == 0
    assert len({name for name, _ in pipeline.STAGES}) == 5
