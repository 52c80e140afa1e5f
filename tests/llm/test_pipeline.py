import corpus_pipeline
from auricle.llm.common import table
from auricle.llm.registry import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_compose(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    counts = []
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, SF)
        assert out.columns == columns, name
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        counts.append(len(rows))
    assert before > counts[0] > counts[1] >= counts[2] == counts[3]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert any("[EMAIL]" in t for t in texts.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    whole = corpus_pipeline.run(spark, SF)
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, last.select(keys).collect())) == sorted(map(tuple, whole.select(keys).collect()))
    assert {r["doc_id"] for r in whole.collect()} == set(texts)


def test_stage_queries_are_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "packing",
    ]
    assert len(QUERIES) == 13 and corpus_pipeline.ORACLE_SQL is None and tokenizer_path()


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").where("doc_id < 0")
    for _, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, SF)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
