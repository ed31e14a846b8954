"""Packing against the tokenizer: every id in one piece, sequences without padding, and what the patterns are for."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations_with_replacement
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripweave.llm import packing
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"
TOKENIZER = Tokenizer.from_file(packing.vocabulary_path())
KNOWN = packing.WordIds(packing.vocabulary_path())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(docs, rows, capacity=4_096):
    """Holds the pieces against whole-text tokens; returns the share of tokens that left the main part of their rest."""
    want = Counter((i, np.array(ids_of(t), "<u4").tobytes()) for i, t in docs)
    tokens = {}
    for i, raw in want:
        tokens.setdefault(i, []).append(raw)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert any(
            len(raw) == 4 * r["doc_tokens"] and crc32(raw[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"]
            for raw in tokens[r["doc_id"]]
        )
    loose = 0
    for i, pieces in by_doc.items():
        spans = Counter()
        for p in pieces:
            assert p["length"] > 0
            spans[p["doc_tokens"]] += p["length"]
        copies = Counter({len(raw) // 4: 0 for raw in tokens[i]})
        for raw in tokens[i]:
            copies[len(raw) // 4] += want[i, raw]
        assert spans == Counter({n: n * k for n, k in copies.items()})
        if sum(copies.values()) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
            assert at == pieces[0]["doc_tokens"]
            rest = [p["length"] for p in pieces if p["length"] < capacity]
            loose += sum(rest) - max(rest, default=0)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and at & (at - 1) == 0
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(1 for p in sequences.values() if sum(x["length"] for x in p) < capacity) <= capacity.bit_length()
    return loose / max(1, sum(r["length"] for r in rows))


def test_given_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert check(docs, packing.op11_packing(spark, SF).collect()) < 0.1


def test_patterns_decide(spark, monkeypatch):
    """Without patterns all documents stand in one line, and its cuts leave much more text away from its document."""
    ready(spark)
    pick = random.Random(3)
    docs = [(k, "a " * pick.randint(20, 2_500)) for k in range(3_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    with_patterns = check(docs, packing.packed(df).collect())
    monkeypatch.setattr(packing, "plan", lambda histogram, units: [])
    without = check(docs, packing.packed(df).collect())
    assert with_patterns < 0.2 * without


def test_all_cases(spark):
    ready(spark)
    docs = [(1, None), (2, ""), (2, ""), (None, "no id here"), (None, None), (3, "x " * 4_095), (4, "x " * 4_096), (5, "long " * 30_000)]
    docs += [(6, "  <|endoftext|>don't É\x1fé1é \x85 İΣ ς\x0b"), (7, "same text twice"), (7, "same text twice"), (7, "another under the id")]
    docs += [(10 + k, "w " * (k % 40)) for k in range(300)]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, start string, length int")
    check(docs, packing.packed(df).collect())
    assert packing.packed(df.limit(0)).collect() == []


@pytest.mark.parametrize("capacity, unit", [(64, 4), (32, 1), (256, 16)])
def test_other_lengths(spark, capacity, unit):
    ready(spark)
    pick = random.Random(capacity)
    docs = [(k, "tok " * int(pick.expovariate(1 / 20))) for k in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(docs, packing.packed(df, capacity=capacity, unit=unit).collect(), capacity)


def put_together(known, text):
    """Ids of the text, next to other texts."""
    texts = [None, "before it.", text, "", "<|endoftext|>", text]
    out = [np.frombuffer(x, "<u4").tolist() for x in known.encoded(pa.array(texts, pa.string()))]
    assert out[0] == out[3] == [] and out[4] == [49407] and out[2] == out[5]
    return out[2]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_words_have_the_ids_of_the_text(text):
    assert put_together(KNOWN, text) == ids_of(text)[:-1]


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("aB1é'’.,;…\u0301\u0338|<> \n\x1f\u00a0İΣst"), max_size=30))
def test_signs_and_marks(text):
    assert put_together(KNOWN, text) == ids_of(text)[:-1]


def test_few_remembered_words(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    known = packing.WordIds(packing.vocabulary_path())
    for text in ("a b c d", "d e", "x<|endoftext|>Y e <|startoftext|>z <|ENDOFTEXT|>", "", "it's 3.14, isn't it.", "e \xff f\x1f g"):
        assert put_together(known, text) == ids_of(text)[:-1]


def test_cheapest_pattern_against_all():
    pick = np.random.default_rng(4)
    for units in (7, 12):
        sizes = np.array([2, 3, 4, 5, 7])
        prices = pick.random(5)
        best = min(
            sum(prices[list(sizes).index(s)] for s in p)
            for n in range(1, units) for p in combinations_with_replacement(sizes.tolist(), n) if sum(p) == units
        )
        cost, pattern = packing.cheapest_pattern(sizes, prices, units)
        assert cost == pytest.approx(best) and pattern @ sizes == units and pattern @ prices == pytest.approx(cost)
    assert packing.cheapest_pattern(np.array([4]), np.array([1.0]), 7)[0] == np.inf


def test_linear_program():
    # 3 + 3 + 1, 4 + 3 and 2 + 2 + 3 fill 7; the best mix of 10 each is known from its dual.
    patterns, amounts, bound = packing.most_sequences(np.array([3, 4]), np.array([10, 4]), 7)
    assert patterns.tolist() == [[1, 1]] and amounts.tolist() == [4.0] and bound >= 4
    pick = np.random.default_rng(9)
    counts = pick.integers(0, 400, 256)
    histogram = {k: int(n) for k, n in enumerate(counts)}
    out = packing.plan(histogram, 256)
    used = Counter()
    for pattern, times in out:
        assert sum(s * n for s, n in pattern.items()) == 256
        used.update({s: n * times for s, n in pattern.items()})
    assert all(used[s] <= histogram[s] for s in used)
    sizes = np.arange(1, 256)
    _, amounts, bound = packing.most_sequences(sizes, counts[1:], 256)
    assert amounts.sum() >= 0.998 * bound
    assert sum(t for _, t in out) >= amounts.sum() - len(amounts)
    assert packing.plan({}, 256) == packing.plan({0: 9}, 256) == packing.plan({200: 9}, 256) == []
