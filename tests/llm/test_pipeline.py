import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import frame, odd, prose
from tests.llm.test_toxicity import text as toxic_or_not


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    licence = "\n".join(prose(70 + i, 8) for i in range(4))
    rows = [(i, toxic_or_not(i, i % 4 == 0), ("en", "de")[i % 2], f"src{i % 5}") for i in range(200)]
    rows += [(300 + i, f"{prose(300 + i, 40)}\n{licence}\n{prose(400 + i, 40)}") for i in range(5)]
    rows += [(500 + i, prose(500, 120) + f" tail{i}") for i in range(4)] + [(400, licence)]
    folder = str(tmp_path_factory.mktemp("tables"))
    frame(spark, rows + odd(600)).select(*corpus_pipeline.COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return folder


def test_decisions_of_each_stage_take_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = {i for i in range(200) if i % 4 == 0}
    assert len(toxic & set(left["toxicity"])) <= 5
    assert len([i for i in range(200) if i % 4 and i in left["toxicity"]]) >= 145
    lines = {i: left["line_dedup"][i].count("\n") for i in range(300, 305) if i in left["line_dedup"]}
    assert lines == {300: 5, 301: 1, 302: 1, 303: 1, 304: 1}
    assert 400 not in left["line_dedup"]
    assert [i for i in range(500, 504) if i in left["near_dedup"]] == [500]
    assert set(left["mixing"]) <= set(left["near_dedup"])


def test_run_packs_what_the_stages_leave(spark, tables):
    pieces = corpus_pipeline.run(spark, tables)
    assert pieces.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sizes and all(r.n <= 2048 and r.n & (r.n - 1) == 0 for r in sizes)


def test_stages_take_empty_tables(spark, tables):
    empty = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).count() == 0
