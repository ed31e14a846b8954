"""The pipeline stage by stage against plain statements of what each keeps."""

from __future__ import annotations

import corpus_pipeline
from test_decontaminate import brute as leaks
from test_jaccard import brute as components
from tripweave.llm import language, toxicity
from tripweave.llm.common import ready, stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        if name == "toxicity":
            judged = toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels")))
            want = {r["doc_id"] for r in judged.collect() if r["score"] < 0.5}
        elif name == "language_id":
            want = {r["doc_id"] for r in language.predict(docs, language.fit(docs)).collect() if r["lang_pred"] != "und"}
        elif name == "jaccard_join":
            want = {i for i, _, c in components([(i, r["text"]) for i, r in before.items()]) if i == c}
        elif name == "decontamination":
            items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
            short = [(i, r["text"]) for i, r in before.items() if len(r["text"]) < 4_000]
            found = {d for d, _ in leaks(short, items)}
            want = None
        else:
            want = set(before)
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        kept = {r["doc_id"] for r in docs.collect()}
        if want is not None:
            assert kept == want
        else:
            assert kept <= set(before) and kept & {d for d, _ in short} == {d for d, _ in short} - found
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and kept
            assert all(r.asDict() == before[r["doc_id"]].asDict() for r in docs.collect())
    assert set(docs.columns) >= {"doc_id", "taken", "target"}


def test_empty_and_null_documents(spark):
    ready(spark)
    schema = table(spark, SF, "documents").schema
    for rows in ([], [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "plain words of a text", "en", "s", 21), (2, "plain words of a text", "en", "s", 21)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 50
