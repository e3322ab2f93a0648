"""Voters are chosen among the labels of the documents that are there."""

from helpers import sentence

from hedonic.llm import neighbours


def test_labels_without_documents_take_no_places(spark):
    import random

    rnd = random.Random(3)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, sentence(rnd, 20)) for i in range(300, 400)], "doc_id long, text string")
    y = neighbours.labelled_features(docs, labels, "quality", 20)[3]
    assert len(y) == 40 and y.sum() == 20
