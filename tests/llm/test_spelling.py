"""Spelling variants against SQL on the given documents and against all pairs of words on made ones."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import pytest

from compare import connect, differences
from tripweave.llm import spelling
from tripweave.llm.common import ready

SF = "/root/testdata/sf0.001"


def edits(a, b):
    """Whether the words are exactly one edit apart, by trying all edits of the shorter one."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def judged(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if edits(v, w)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def brute(docs, slip=199):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return judged(counts)


def found(spark, docs, **more):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n long")
    return sorted(tuple(r) for r in spelling.variants(df, **more).collect())


def test_given_documents_against_sql(spark):
    assert differences(spelling.op13_spelling_variants(spark, SF), connect(SF).sql(spelling.OP13_SQL)) is None


def test_made_documents(spark):
    ready(spark)
    pick = random.Random(5)
    base = ["".join(pick.choice("abcdeéÿ×") for _ in range(pick.randint(5, 9))) for _ in range(60)]
    docs = []
    for k in range(400):
        words = []
        for _ in range(60):
            w = base[min(int(pick.expovariate(0.08)), 59)]
            if pick.random() < 0.3:
                at = pick.randrange(len(w))
                w = pick.choice([w[:at] + w[at + 1 :], w[:at] + pick.choice("abc") + w[at + 1 :], w[:at] + "d" + w[at:]])
            words.append(w.title() if pick.random() < 0.1 else w)
        docs.append((k, pick.choice([" ", "-", "\n"]).join(words)))
    docs += [(None, docs[0][1]), (7, docs[1][1]), (8, None), (9, ""), (10, "É" * 30_000), (11, " ".join(["ÉTUDES"] * 9 + ["études"] * 9))]
    want = brute(docs, 19)
    assert found(spark, docs, slip=19) == want
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[1] != r[2] for r in want)


@pytest.mark.parametrize("named, crowd", [(0, 2), (3, 2), (16, 1_000)])
def test_pairs_do_not_depend_on_the_subtrees(spark, monkeypatch, named, crowd):
    """Rearrangements of the same letters share leaves; their pairs are still found through places left out."""
    ready(spark)
    monkeypatch.setattr(spelling, "CROWD", crowd)
    words = {"".join(p) for p in permutations("abcdef")} | {"".join(p) for p in permutations("abcde")} | {"aacdef", "abqdef", "q" * 6, "a" * 7, "aaaaaab", "zbcdefg"}
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    rows = [tuple(r) for r in spelling.near_words(df, named).collect()]
    assert sorted(rows) == sorted((a, b, len(b)) for a in words for b in words if edits(a, b))


def test_subtrees_get_more_levels(spark):
    ready(spark)
    df = spark.createDataFrame([("".join(p), 5) for p in permutations("abcdpq")], "word string, n long")
    assert spelling.levels_for(df) == spelling.NAMED
    assert spelling.levels_for(df, 10) == spelling.GROUPS


def test_empty(spark):
    ready(spark)
    assert found(spark, []) == []
    assert found(spark, [(1, None), (None, "")]) == []
