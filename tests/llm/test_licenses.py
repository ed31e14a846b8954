"""License finds: given notices, alignment, edge cases."""

from __future__ import annotations

import random
import re

import pytest

from tripweave.llm import licenses
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def test_given_notices(spark):
    found = {(r["doc_id"], r["license"]) for r in licenses.op8_license_scan(spark, SF).collect()}
    want = set()
    for r in table(spark, SF, "documents").select("doc_id", "text").collect():
        for name in ("all-rights-reserved", "apache-2.0-notice", "cc-by-nc-4.0-notice", "gpl-3.0-notice", "mit-notice"):
            if licenses.TEMPLATES[name] in r["text"]:
                want.add((r["doc_id"], name))
    assert want and want <= found


def common(a, b):
    """Length of a longest common subsequence, by the table of all prefixes."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_every_find_is_there(spark):
    """No false finds: the stretch holds the share of the template's words that is claimed, in order."""
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    rows = licenses.op8_license_scan(spark, SF).collect()
    for r in rows:
        template = licenses.words_of(licenses.TEMPLATES[r["license"]])[0]
        stretch = licenses.words_of(texts[r["doc_id"]][r["start_char"] : r["end_char"]])[0]
        assert common(template, stretch) >= r["n_words"] >= licenses.COVERAGE * len(template)
        assert r["coverage"] == pytest.approx(r["n_words"] / len(template))
    # Whole notices are found in just the documents that hold their words one after the other.
    for name in ("mit-notice", "cc-by-nc-4.0-notice", "all-rights-reserved", "gpl-3.0-notice"):
        notice = f" {' '.join(licenses.words_of(licenses.TEMPLATES[name])[0])} "
        want = {i for i, t in texts.items() if notice in f" {' '.join(licenses.words_of(t or '')[0])} "}
        assert {r["doc_id"] for r in rows if r["license"] == name and r["coverage"] == 1.0} == want


def test_templates_from_a_table(spark):
    ready(spark)
    rows = [("own", "This text may be used by friends of the house only."), ("none", None), (None, "x"), ("blank", " . ")]
    found = licenses.templates_from(spark.createDataFrame(rows, "name string, text string"))
    assert list(found) == ["own"]
    docs = spark.createDataFrame([(1, "It says: this text may be used by friends of the house only!"), (2, "nothing")], "doc_id long, text string")
    assert [[x["license"] for x in r["licenses"]] for r in licenses.scan(docs, found).orderBy("doc_id").collect()] == [["own"], []]
    twice = spark.createDataFrame([("a", "x y"), ("a", "z")], "name string, text string")
    with pytest.raises(ValueError):
        licenses.templates_from(twice)
    with pytest.raises(ValueError):
        licenses.templates_from(twice, most=1)


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_template_is_found_where_it_stands(name):
    index = licenses.TemplateIndex(licenses.TEMPLATES)
    text = "Some words before it. " + licenses.TEMPLATES[name].upper() + "\nand after, the license of it."
    found = index.scan(text)
    assert [f["license"] for f in found] == [name] and found[0]["coverage"] == 1.0
    assert re.sub(r"\W", "", text[found[0]["start"] : found[0]["end"]]) == re.sub(r"\W", "", licenses.TEMPLATES[name].upper())


def test_edited_text_is_still_found():
    rng = random.Random(1)
    words = licenses.TEMPLATES["mit"].split()
    for k in rng.sample(range(len(words)), 8):
        words[k] = "changed"
    found = licenses.TemplateIndex(licenses.TEMPLATES).scan("x " * 300 + " ".join(words) + " y" * 300)
    assert [f["license"] for f in found] == ["mit"] and 0.85 <= found[0]["coverage"] < 1


def test_repeated_notice_is_found_each_time():
    text = "\n".join(["Released under the MIT License."] * 500)
    assert len(licenses.TemplateIndex(licenses.TEMPLATES).scan(text)) == 500


def test_alignment_is_increasing():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        out = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in out)
        assert all(i < k and j < m for (i, j), (k, m) in zip(out, out[1:]))
        assert len(licenses.align(a, a)) == len(a)
        values = [rng.randrange(9) for _ in range(rng.randrange(9))]
        best = licenses.increasing(values)
        assert all(values[i] < values[j] for i, j in zip(best, best[1:]))


def test_edge_cases(spark):
    ready(spark)
    df = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "the " * 200_000, "x"), (3, "MIT License", "x")], "doc_id long, text string, licenses string")
    assert [len(r["licenses"]) for r in licenses.scan(df).collect()] == [0, 0, 0, 0]
    assert licenses.scan(df.limit(0)).count() == 0 and licenses.scan(df, {}).count() == 4
