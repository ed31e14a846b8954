"""Noisy-or model: held-out accuracy, located sentences, edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import toxicity
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = toxicity.op1_toxicity(spark, SF)
    assert out.count() == table(spark, SF, "documents").count()
    both = out.join(table(spark, SF, "labels").select("doc_id", "toxic"), "doc_id").filter("held_out")
    n, right = both.agg(F.count("*"), F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()
    assert n > 50 and right >= 0.95
    assert out.filter("score < 0 or score > 1 or score is null or (predicted = 1) <> (score >= 0.5)").isEmpty()


def test_noisy_or_of_sentences():
    model = toxicity.NoisyOrModel(-3.0, {"bad": 5.0, "bad~": 1.0, "nice": -2.0})
    words = toxicity._WordWeights(model.weights)
    text = "All is well. You are Bad bad!\nnice day"
    got = toxicity.score_text(text, model, words)
    p = [1 / (1 + np.exp(-z)) for z in (-3.0, 3.0, -5.0)]
    assert got["score"] == pytest.approx(1 - np.prod([1 - x for x in p]))
    assert [text[s["start"] : s["end"]].strip() for s in got["spans"]] == ["You are Bad bad!"]


def test_learns_from_document_labels_which_sentence_is_bad(spark):
    ready(spark)
    rows = [(i, f"Word{i % 7} here. " + ("You zorg person! " if i % 4 == 0 else "") + f"More text {i % 5}.") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(200)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    for r in out:
        assert (r["score"] >= 0.5) == ("zorg" in r["text"])
        assert [r["text"][s["start"] : s["end"]].strip() for s in r["spans"]] == (["You zorg person!"] if "zorg" in r["text"] else [])


def test_edge_cases(spark):
    ready(spark)
    docs = spark.createDataFrame(
        [(1, None, 0.1, "s"), (2, "", 0.2, "s"), (None, "text. " * 100_000, 0.3, "s"), (4, "x", 0.4, "s"), (4, "x", 0.4, "s")],
        "doc_id long, text string, score double, Spans string",
    )
    for labels in ([], [(1, 1)], [(None, 1), (2, None), (3, 0), (3, 0)]):
        labels = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()] == pytest.approx([0.0] * 5, abs=1e-6)
        assert toxicity.keep_clean(docs, labels).columns == docs.columns
    assert toxicity.score(docs.limit(0), toxicity.NoisyOrModel()).count() == 0
