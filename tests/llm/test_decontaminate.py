"""Leaks against a search of all windows without fingerprints."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tripweave.llm import decontaminate as de
from tripweave.llm.common import WordHashes, ready, shingle_hashes, table, word_hashes

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    """``{(doc, item): similarity}`` over all item-sized windows of all documents."""
    memo, out = WordHashes(), {}
    words = [(i, word_hashes(t, memo)) for i, t in items if t]
    for d, text in docs:
        own = word_hashes(text or "", memo)
        for i, w in words:
            if not len(w):
                continue
            want = Counter(shingle_hashes(w, 5).tolist())
            for a in range(max(0, len(own) - len(w)) + 1):
                window = own[a : a + len(w)]
                similarity = de.weighted_jaccard(Counter(shingle_hashes(window, 5).tolist()), want)
                if similarity >= 0.75:
                    out[d, i] = max(similarity, out.get((d, i), 0))
    return out


def run(spark, docs, items):
    ready(spark)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], m["item_id"]): m["similarity"] for r in de.find_matches(df, bench).collect() for m in r["matches"]}


def test_edited_passages(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(500)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((1, 2, 4, 5, 6, 9, 14, 20, 36, 36, 59))]
    items += [(20, items[6][1]), (21, None), (22, " "), (23, "a a a a a a a a a a a a")]
    docs = []
    for d in range(120):
        passage = rng.choice(items[:11])[1].split()
        for _ in range(rng.randrange(3)):
            at = rng.randrange(max(1, len(passage)))
            passage[at : at + 1] = rng.choice(([], [word()], [word(), *passage[at : at + 1]]))
        docs.append((d, " ".join([*[word() for _ in range(rng.randrange(30))], *passage, *[word() for _ in range(rng.randrange(30))]]).upper()))
    docs += [(200, None), (201, ""), (202, "a a a a a a a a a a a a"), (203, "a a a a a a a a a a a a a a a a"), (202, "b")]
    got, want = run(spark, docs, items), brute(docs, items)
    assert len(want) > 60 and got == pytest.approx(want)


def test_given_documents(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    memo = WordHashes()
    index = de.ItemIndex(items)
    # Only documents that share a shingle need the slow search.
    near = [(d, t) for d, t in docs if t and np.isin(shingle_hashes(word_hashes(t, memo), 5), index.known).any()]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in de.op4_decontamination(spark, SF).collect()}
    assert got == pytest.approx(brute(near, items)) and got


def test_chunks_of_items_give_the_same(spark, monkeypatch):
    docs = [(1, "x a b c d e f y"), (2, "p q r s t u"), (3, "z")]
    items = [(1, "a b c d e f"), (2, "p q r s t u"), (3, "l m n o p q")]
    whole = run(spark, docs, items)
    monkeypatch.setattr(de, "CHUNK_WORDS", 5)
    assert run(spark, docs, items) == whole == {(1, 1): 1.0, (2, 2): 1.0}


def test_edge_cases(spark):
    ready(spark)
    df = spark.createDataFrame([(None, "a b c d e f", "m"), (1, None, "m"), (2, "clean " * 100_000, "m"), (3, "fine", "m")], "doc_id long, text string, Matches string")
    bench = spark.createDataFrame([(1, "a b c d e f"), (None, "clean clean")], "item_id long, text string")
    assert de.keep_clean(df, bench).columns == df.columns
    # An item without an id is an item: the document that holds its text goes.
    assert sorted(r["doc_id"] for r in de.keep_clean(df, bench).collect()) == [1, 3]
    found = {(r["doc_id"], m["item_id"]) for r in de.find_matches(df, bench).collect() for m in r["matches"]}
    assert found == {(None, 1), (2, None)}
    assert de.keep_clean(df, bench.limit(0)).count() == 4 and de.keep_clean(df.limit(0), bench).count() == 0


def test_block_index_finds_all_within_radius():
    rng = np.random.default_rng(4)
    index = de.ItemIndex([(k, " ".join(f"v{k}-{j}" for j in range(12))) for k in range(40)])
    for k, (_, size, _, mark) in enumerate(index.items):
        for _ in range(20):
            flips = rng.choice(64, rng.integers(0, de.RADIUS + 1), replace=False)
            other = mark ^ np.uint64(sum(1 << int(f) for f in flips))
            assert k in index.candidates(other, size)
