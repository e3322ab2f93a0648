"""The pipeline's stages on a small table, and every registered query with SQL."""

import os
import sys

import pytest
from helpers import documents, empty

import corpus_pipeline
from hedonic.llm import catalog, neighbours, rules, simhash

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import check_queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, tmp_path):
    known = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    known.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_keep_columns_and_decide(spark, folder):
    docs = documents(spark, clashing=True)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "five-word near-duplicates", "best-fit packing"]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], folder).cache())
        assert kept[-1].schema == docs.schema and kept[-1].count() <= kept[-2].count()
    ids = lambda df: sorted(r["doc_id"] if r["doc_id"] is not None else -99 for r in df.select("doc_id").collect())
    assert ids(kept[1]) == ids(rules.judge(docs).filter("kept"))
    known = spark.read.parquet(f"{folder}/labels.parquet")
    assert ids(kept[2]) == ids(neighbours.score(kept[1].drop("score"), neighbours.fit(kept[1], known), ["doc_id"]).filter("score >= 0.3"))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[3], folder)
    assert {r["doc_id"] for r in packed.collect()} == set(ids(kept[3]))


def test_an_empty_table_passes(spark, folder):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    verdict, _ = check_queries.compare(spark, check_queries.connect(SF_DIR), name, catalog.QUERIES[name], catalog.ORACLES[name], SF_DIR)
    assert verdict.startswith("ok"), verdict


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_every_operator_is_registered():
    import __spark_entry__

    assert {int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
