"""The filter audit against a walk through every order, document by document."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

from compare import connect, differences
from tripweave.llm import audit
from tripweave.llm.common import ready

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, part string, N long"
LABELS = "doc_id long, quality int, toxic int, mask int"


def brute(docs, labels):
    """Rows as tuples ``(part, order, step, kept, removed, redundant, unique, good, toxic, shapley)``."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        parts[s or ""].append((i, fails))
    out, share = [], Counter()
    for part, members in parts.items():
        for order in map("".join, permutations("ABCDE")):
            alive = list(members)
            for step, f in enumerate(order, 1):
                gone = [m for m in alive if m[1][f]]
                left = [m for m in alive if not m[1][f]]
                failing = [m for m in members if m[1][f]]
                unique = sum(sum(m[1].values()) == 1 for m in failing)
                out.append((part, order, step, len(left), len(gone), len(failing) - len(gone), unique,
                            sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone)))
                share[part, f] += len(gone)
                alive = left
    return sorted((*r, share[r[0], r[1][r[2] - 1]]) for r in out)


def found(spark, docs, labels):
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], DOCS)
    counted = audit.cells(d, spark.createDataFrame([(*r, 3) for r in labels], LABELS))
    return sorted(tuple(r) for r in audit.audit(counted).collect())


def test_given_tables_against_sql(spark):
    assert differences(audit.op12_filter_audit(spark, SF), connect(SF).sql(audit.OP12_SQL)) is None


def test_all_cases(spark):
    ready(spark)
    many = " ".join(f"word{k}" for k in range(60))
    texts = [None, "", "short one", many, many + " #", "Few WORDS HERE", "dull " * 80, "dull " * 80 + "$", many.title(), "AB " * 70 + "%",
             " ".join(["nbsp"] * 60), "é ü " * 40, "\t\n\x0b\x0c\r", "x " * 200_000]
    docs = [(k, t, s) for k, t in enumerate(texts * 2) for s in (None if k % 3 else "", f"s{k % 2}")]
    docs += [(None, many, "s0"), (None, many, "s0"), (None, None, None), (3, many, "s1"), (500, many, "solo"), (500, many, "solo")]
    labels = [(k, k % 2, (k + 1) % 2) for k in range(20)] + [(500, None, 1), (500, 1, None), (None, 1, 1), (7, 0, 0), (999, 1, 1)]
    got = found(spark, docs, labels)
    assert got == brute(docs, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in docs})


def test_one_text_fills_the_table(spark):
    ready(spark)
    docs = [(k, "the same text", f"s{k % 3}") for k in range(3_000)]
    assert found(spark, docs, []) == brute(docs, [])


def test_empty(spark):
    ready(spark)
    assert found(spark, [], []) == []
    assert found(spark, [], [(1, 1, 1)]) == []
