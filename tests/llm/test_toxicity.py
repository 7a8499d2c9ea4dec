"""Toxicity: features by hand, held-out accuracy, awkward rows."""

import math
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from aislewatch.llm import toxicity
from aislewatch.llm.toxicity import FEATURES, Weights, measure

LEXICON = {"idiot": 4.0, "moron": 3.0, "vequ*": 2.0}
LARGER = "/root/testdata/sf0.1"


def features(text):
    return dict(zip(FEATURES, measure(text, Weights(LEXICON)), strict=True))


def test_features_by_hand():
    f = features("You are an idiot. The weather is mild today, they all said so; a MORON spoke!")
    assert f["words"] == pytest.approx(math.log1p(16)) and f["lexicon_density"] == pytest.approx(7 / 16)
    assert f["heaviest"] == 4.0 and f["lexicon_words"] == pytest.approx(math.log1p(2))
    assert f["second_person"] == pytest.approx(1 / 16) and f["near_second_person"] == pytest.approx(1 / 16)
    assert f["shouted"] == pytest.approx(1 / 16) and f["exclamations"] == pytest.approx(1 / 16)
    assert features("veqution vequ veq")["lexicon_density"] == pytest.approx(2 / 3)
    hidden = features("what an id1ot, m0r@n and st*pid")
    assert hidden["disguised"] > 0 and hidden["disguised_lexicon"] > 0 and hidden["heaviest"] == 0
    assert features("sooooo well-known")["disguised"] == 0 and features("sooooo")["lengthened"] == 1
    assert measure("", Weights(LEXICON)) == [0.0] * len(FEATURES)


def test_remembered_words_are_bounded():
    weights = Weights(LEXICON)
    weights.MOST = 3
    for k in range(10):
        assert weights[f"word{k}"] == 0.0
    assert len(weights) <= 3 and weights["idiot"] == 4.0


@pytest.fixture(scope="module")
def labelled(spark):
    """Every labelled document of a larger folder, with its fold."""
    if not os.path.exists(LARGER):
        pytest.skip("the larger tables are not here")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").join(labels, "doc_id", "left_semi")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.withColumn("held_out", held_out).cache(), labels.withColumn("held_out", held_out)


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = toxicity.train(docs.filter("not held_out"), labels.filter("not held_out"))
    assert 0 < len(model.lexicon) <= toxicity.LEXICON_TERMS
    rows = toxicity.score(docs, model, ["doc_id", "held_out"]).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    toxic, clean = [r for r in held if r.toxic == 1], [r for r in held if r.toxic == 0]
    assert len(toxic) > 50
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    # Calibrated: scores add up to about as many toxic rows as there are.
    assert sum(r.score for r in held) == pytest.approx(len(toxic), rel=0.25)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_query_covers_the_table_and_ignores_held_out_labels(spark, folder, tmp_path):
    rows = {r.doc_id: r for r in entry_module.queries()["op12_toxicity"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(rows) == docs.count()
    fold = {r.doc_id: r.f for r in docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("f")).collect()}
    assert {i: r.held_out for i, r in rows.items()} == fold
    # Other labels of held-out rows, languages and sources change nothing.
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    spark.read.parquet(f"{folder}/labels.parquet").withColumn("toxic", changed.cast("int")).write.parquet(f"{tmp_path}/labels.parquet")
    docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}).write.parquet(f"{tmp_path}/documents.parquet")
    again = {r.doc_id: r for r in entry_module.queries()["op12_toxicity"](spark, str(tmp_path)).collect()}
    assert again == rows


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (5, 0), (None, 1), (7, None), (9, 1), (3, 7)], "doc_id bigint, toxic int")
    sample = {r.doc_id: r for r in toxicity.labelled_sample(awkward, labels).collect()}
    assert {i: r.label for i, r in sample.items()} == {1: 1.0, 4: 0.0, 5: 0.0}
    model = toxicity.train(awkward, labels)
    found = toxicity.score(awkward, model, ["doc_id", "region"])
    assert found.columns == ["doc_id", "region", "score", "predicted"] and found.count() == awkward.count()
    by = {}
    for r in found.collect():
        assert 0 <= r.score <= 1
        by.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by.values()) and by[2] == by[3]
    assert toxicity.score(empty, model, ["doc_id"]).collect() == []
    for docs, marks in ((empty, labels), (awkward, labels.limit(0)), (awkward, labels.filter("toxic = 0"))):
        none = toxicity.train(docs, marks)
        assert none.trees is None and none.share == 0.0
        assert {(r.score, r.predicted) for r in toxicity.score(awkward, none, ["doc_id"]).collect()} == {(0.0, 0)}
    only = toxicity.train(awkward, labels.filter("toxic = 1"))
    assert only.share in (0.0, 1.0)
