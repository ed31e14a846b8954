"""Context trees against a plain statement of the model, and held-out accuracy."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import language
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def counts_of(texts):
    parts = [language.grams(np.frombuffer(language.encode(t), np.uint8)) for t in texts]
    return np.unique(np.concatenate(parts), return_counts=True)


def plain_bits(train, text):
    """Code length of a text by walking down the orders byte by byte."""
    seen = [{} for _ in range(language.ORDER + 1)]
    for t in train:
        data = language.encode(t)
        for i in range(language.ORDER, len(data)):
            for k in range(language.ORDER + 1):
                seen[k].setdefault(data[i - k : i], Counter())[data[i]] += 1
    bits, data = 0.0, language.encode(text)
    for i in range(language.ORDER, len(data)):
        for k in range(language.ORDER, -1, -1):
            c = seen[k].get(data[i - k : i])
            if c is None:
                continue
            n, t = sum(c.values()), len(c)
            if data[i] in c:
                bits += np.log2((n + t) / c[data[i]])
                break
            bits += np.log2((n + t) / t)
        else:
            bits += 8.0
    return bits


def test_cost_is_the_model():
    train = {"a": ["the cat sat on the mat", "the hat"], "b": ["le chat est là", "la chatte"]}
    trees = language.compile_trees({k: counts_of(v) for k, v in train.items()})
    for text in ("the cat", "le chat là", "zzz ü", "that", "t"):
        cost = trees.cost(language.grams(np.frombuffer(language.encode(text), np.uint8))).sum(axis=0)
        assert cost == pytest.approx([plain_bits(train["a"], text), plain_bits(train["b"], text)], rel=1e-5)


def test_segments_do_not_change_the_result(monkeypatch):
    trees = language.compile_trees({"a": counts_of(["abc abd"]), "b": counts_of(["xyz"])})
    texts = ["abcabdxyz" * 50, "", None, "x1y2", "123"]
    whole = language.classify(texts, trees)
    monkeypatch.setattr(language, "SEGMENT", 7)
    for x, y in zip(whole, language.classify(texts, trees)):
        assert x["lang_pred"] == y["lang_pred"] and x["bits"] == pytest.approx(y["bits"], rel=1e-5)
    assert [x["lang_pred"] for x in whole] == ["a", "und", "und", "b", "und"]


def test_held_out_accuracy(spark):
    out = language.op10_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    right, n, folds = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.max("score")).first()
    assert n > 200 and right >= 0.99 and 0 <= folds <= 1
    assert out.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)).isEmpty()


def test_edge_cases(spark):
    ready(spark)
    schema = "doc_id long, text string, lang string, score int, bits string"
    empty = spark.createDataFrame([], schema)
    assert language.fit(empty) is None
    assert language.keep_known(empty).columns == empty.columns
    rows = [(i, "hello there my friend" if i % 2 else "bonjour mon ami", "en" if i % 2 else "fr", 1, "x") for i in range(40)]
    rows += [(None, None, None, None, None), (41, "", "en", 1, "x"), (42, "123 !?", "en", 1, "x"), (42, "hello my friend " * 20_000, None, 1, "x")]
    df = spark.createDataFrame(rows, schema)
    got = [(r["text"], r["lang_pred"], r["score"]) for r in language.predict(df, language.fit(df)).collect()]
    assert len(got) == len(rows)
    for text, lang, score in got:
        assert 0 <= score <= 1
        assert lang == ("und" if not text or text[0] == "1" else "en" if text[0] == "h" else "fr")
    assert language.keep_known(df).columns == df.columns and language.keep_known(df).count() == 41


def test_short_texts_of_no_sure_language_stay(spark):
    ready(spark)
    rows = [(k, "the same words in all of them", f"l{k % 12}") for k in range(120)]
    rows += [(200, "in", None), (201, "12 ?", None), (202, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = {r["doc_id"]: r for r in language.predict(df, language.fit(df)).collect()}
    assert judged[200]["lang_pred"] != "und" and judged[200]["score"] < 0.5
    assert {r["doc_id"] for r in language.keep_known(df).collect()} == {*range(120), 200}
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in language.keep_known(bare).collect()} == {*range(120), 200}


def test_numbers_are_no_letters(spark):
    ready(spark)
    rows = [(k, "hello my friend" if k % 2 else "bonjour mon ami", "en" if k % 2 else "fr") for k in range(40)]
    rows += [(50, "½ ² ①", None), (51, "Ⅷ 12", None), (52, "_ 7", None), (53, "ª hello", None), (54, "字", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(df, language.fit(df)).collect()}
    assert all(judged[k] == ("und", 0.0) for k in (50, 51, 52))
    assert judged[53][0] == "en" and judged[54][0] in ("en", "fr")


def test_many_languages_are_bounded(spark, monkeypatch):
    ready(spark)
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = [(k, "hello my friend" if k % 2 else "bonjour mon ami", "en" if k % 2 else "fr") for k in range(40)]
    rows += [(100 + k, "dirty", f"x{k}") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(df).languages == ["en", "fr"]
