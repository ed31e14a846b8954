"""The Jaccard join against all pairs, on given and on hand-made documents."""

from __future__ import annotations

import random
import re

import pytest

from tripweave.llm import jaccard
from tripweave.llm.common import ready

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """``{(id, n, component)}`` by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k))) for k, (i, s) in enumerate(sets)), key=str)


def run(spark, rows):
    ready(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)


def edited(words, rng, edits):
    out = list(words)
    for _ in range(edits):
        kind, at = rng.random(), rng.randrange(len(out))
        if kind < 0.4:
            out[at] = f"x{rng.randrange(10**6)}"
        elif kind < 0.7 and len(out) > 6:
            del out[at]
        else:
            out.insert(at, f"y{rng.randrange(10**6)}")
    return out


@pytest.fixture(scope="module")
def synthetic():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for size in (1, 3, 5, 6, 7, 8, 9, 12, 16, 24, 33, 40, 60, 200):
        for _ in range(3):
            base = [rng.choice(vocabulary) for _ in range(size)]
            for copy in range(6):
                rows.append(" ".join(edited(base, rng, rng.choice((0, 0, 1, 2, size // 30 + 1)) if copy else 0)))
    # Documents that share most of a passage, around the threshold.
    for k in range(30):
        rows.append(" ".join(passage[: rng.randrange(44, 61)] + [f"z{k}-{j}" for j in range(rng.randrange(14))]))
    rng.shuffle(rows)
    return [(1000 + i, t) for i, t in enumerate(rows)]


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)


def test_edited_copies(spark, synthetic):
    assert run(spark, synthetic) == brute(synthetic)


@pytest.mark.parametrize("small", [3, 12, 60])
def test_any_boundary_gives_the_same(spark, synthetic, small, monkeypatch):
    monkeypatch.setattr(jaccard, "boundary", lambda _: small)
    assert run(spark, synthetic[:170]) == brute(synthetic[:170])


@pytest.mark.parametrize("with_base", [True, False])
def test_group_of_copies_around_the_threshold(spark, with_base):
    """Copies with up to eight edits of one text; many are too far from it, some are copies of such a copy."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    texts = [edited(base, rng, rng.randrange(9)) for _ in range(110)] + ([base] if with_base else [])
    far = edited(base, rng, 7)
    texts += [edited(far, rng, rng.randrange(4)) for _ in range(15)]
    texts += [base[: rng.randrange(90, 150)] for _ in range(12)] + [far[rng.randrange(50) :] for _ in range(8)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    copy = "a b c d e f g h"
    rows = [(7, None), (8, ""), (9, " \n\t"), (3, copy), (2, copy.upper()), (2, copy.upper()), (None, copy), (5, "one two"), (4, "one\ttwo"),
            (11, "one two three"), (12, " one two"), (13, "long " * 50_000), (14, "long " * 50_001)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_keep_one_keeps_columns(spark):
    ready(spark)
    df = spark.createDataFrame(
        [(1, "a b c d e f", "x", 0.5), (2, "a b c d e f", "y", 1.0), (3, None, "z", 2.0), (None, "q r s t u v", "n", 3.0)],
        "doc_id long, text string, component_id string, score double",
    )
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, None]


def test_frequent_order_loses_nothing(spark, synthetic, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 5)
    assert run(spark, synthetic[:150]) == brute(synthetic[:150])


def test_keep_one_judges_rows(spark):
    ready(spark)
    one, two, three = "a b c d e f", "some other words that stand alone", "k l m n o p q"
    rows = [
        (1, one, "x", 1), (2, one.upper(), "y", 1), (2, two, "y", 2), (3, three, "z", 1), (3, three, "z", 1), (4, three + " r s", "z", 1),
        (None, "no id at all here", "n", 1), (None, "no id at all here", "n", 1), (None, one, "n", 1), (5, None, "e", 1), (5, "", "e", 1), (5, None, "e", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, n int")
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    want = [rows[0], rows[2], rows[3], rows[5], rows[6], rows[9], rows[10], rows[11]]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
    assert jaccard.keep_one(df.limit(0)).collect() == []


def test_many_rows_without_an_id(spark):
    """Null ids are no shared key: each row is found again by its id and text."""
    rng = random.Random(2)
    base = [[f"v{rng.randrange(900)}" for _ in range(40)] for _ in range(30)]
    rows = [(None if k % 3 else k // 40, " ".join(edited(base[k % 30], rng, k % 3))) for k in range(400)]
    assert run(spark, rows) == brute(rows)


def test_groups_in_parts_give_the_same(spark, synthetic, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 2)
    assert run(spark, synthetic[:150]) == brute(synthetic[:150])


def test_a_sample_of_rows_gives_the_same(spark, synthetic, monkeypatch):
    monkeypatch.setattr(jaccard.frequent_elements, "__defaults__", ("text", 20))
    assert run(spark, synthetic[:150]) == brute(synthetic[:150])


def test_intermediate_tables_are_deleted(spark, synthetic):
    from pathlib import Path

    from tripweave.session import shared_root

    ready(spark)
    root = Path(shared_root(spark)) / "llm"
    before = set(root.glob("jaccard-*/*"))
    out = jaccard.near_duplicates(spark.createDataFrame(synthetic[:60], "doc_id long, text string"))
    assert {p.name for p in set(root.glob("jaccard-*/*")) - before} == {"classified", "least"}
    assert out.count() == 60


def test_frequent_elements_are_counted_in_all_documents(spark):
    ready(spark)
    docs = spark.range(0, 45_000, 1, 3).selectExpr("concat('one two three four five x', id) as text")
    elements, times, _ = jaccard.frequent_elements(docs)
    assert elements.tolist() == sorted(elements.tolist()) and times.tolist() == [45_000]
