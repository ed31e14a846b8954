"""Rule ensemble: held-out accuracy, compiled rules against the matrix, edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import quality
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = quality.op7_quality(spark, SF)
    assert out.count() == table(spark, SF, "documents").count()
    both = out.join(table(spark, SF, "labels").select("doc_id", "quality"), "doc_id").filter("held_out")
    n, right = both.agg(F.count("*"), F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert n > 50 and right >= 0.95
    assert out.filter("score < 0 or score > 1 or score is null or (predicted = 1) <> (score >= 0.3)").isEmpty()


def test_columns_are_the_model(spark):
    ready(spark)
    texts = ["Plain words, here and there.", "$$$ ### !!!", "A|B|C " * 30, "same same same same", None, "", "é" * 9, "UPPER CASE", "x" * 200_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rules = [frozenset({quality.Condition("marks", 0.5, True)}), frozenset({quality.Condition("words", 4.0, False), quality.Condition("repeats", 0.1, False)})]
    model = quality.RuleEnsemble(0.3, list(zip(rules, (-2.0, 0.7))))
    x = np.array([quality.statistics_of(t) for t in texts])
    want = 1 / (1 + np.exp(-(0.3 + quality.rule_matrix(x, rules) @ np.array([-2.0, 0.7]))))
    got = [r["score"] for r in quality.score(docs, model).orderBy("doc_id").collect()]
    assert got == pytest.approx(want.tolist())


def test_lasso_keeps_few_rules():
    rng = np.random.default_rng(0)
    x = np.zeros((600, len(quality.STATISTICS)))
    x[:, :6] = rng.random((600, 6))
    y = (x[:, 1] > 0.5).astype(float)
    rules = quality.grow_rules(x, y)
    b, w = quality.lasso_logistic(quality.rule_matrix(x, rules), y)
    assert 0 < (np.abs(w) > 1e-6).sum() < len(rules) / 2
    assert (((quality.rule_matrix(x, rules) @ w + b) > 0) == (y > 0)).mean() > 0.98


def test_a_capped_sample_keeps_the_prior(spark):
    ready(spark)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(6_000):
        y = int(rng.random() < 0.86)
        marks = rng.binomial(12, 0.3 if y else 0.45)  # the classes overlap
        rows.append((i, " ".join(["word"] * int(rng.integers(10, 14)) + ["!"] * int(marks)), y))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4).cache()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    whole, capped = (
        np.array([r["score"] for r in quality.score(docs, quality.fit(docs, labels, per_class=n)).orderBy("doc_id").collect()])
        for n in (10_000, 500)
    )
    assert whole.mean() == pytest.approx(0.86, abs=0.02)
    assert capped.mean() == pytest.approx(whole.mean(), abs=0.02)
    assert np.abs(capped - whole).mean() < 0.05
    assert ((capped >= 0.3) != (whole >= 0.3)).mean() < 0.03


def test_edge_cases(spark):
    ready(spark)
    docs = spark.createDataFrame([(1, None, 2.0), (None, "", 1.0), (3, "abc", 0.0)], "doc_id long, text string, score double")
    for labels, share in (([], 0.5), ([(1, 1), (None, 0), (3, None)], 0.999)):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert [r["score"] for r in quality.score(docs, model).collect()] == pytest.approx([share] * 3)
    assert quality.score(docs.limit(0), quality.RuleEnsemble()).count() == 0
