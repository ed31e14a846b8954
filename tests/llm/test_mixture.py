"""The mix against its definition."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripweave.llm import mixture
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Targets by sharing the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] >= 2 * sizes[s]}
        if not full:
            out |= {s: unit * weight[s] for s in open_}
            break
        out |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


def check(rows, slack):
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = plain_targets(size)
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= slack
    assert all(r["source_size"] == size[r["source"]] for r in rows)


def test_given_documents(spark):
    out = mixture.op6_mixture(spark, SF).collect()
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    assert len(out) == len(docs)
    for r in out:
        assert r["size"] == len(docs[r["doc_id"]]["text"].encode().split())
    check(out, 20)
    again = mixture.op6_mixture(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


@pytest.mark.parametrize("bucket, words", [(20_000, 1), (2, 150)])
def test_uneven_sources(spark, monkeypatch, bucket, words):
    ready(spark)
    monkeypatch.setattr(mixture, "BUCKET_ROWS", bucket)
    rows = [(k, ("w " * (1 + k % 50)).strip(), f"s{(k % 40) ** 2 // 90}") for k in range(600)]
    rows += [(700, None, "s1"), (701, "", "empty"), (702, "a b c", None), (702, "a b c", None), (None, "x y", "s3"), (703, "big " * 9_000, "Z"), (704, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed, pieces = mixture.mix(df, block=words)
    out = mixture.taken(df, block=words).collect()
    assert len(out) == len(rows)
    check(out, 20)
    # Every slot holds one block of its source: as many words as a block has, unless the second pass ends in it.
    filled, blocks, ends = Counter(), defaultdict(set), {}
    for p in pieces.join(placed.select("nth", "source_size").distinct(), "nth").collect():
        filled[p["slot"]] += p["words"]
        blocks[p["nth"]].add(p["block"])
        ends[p["slot"]] = 2 * p["source_size"] - p["block"] * words
    assert all(n == min(words, ends[s]) for s, n in filled.items())
    assert all(b == set(range(len(b))) for b in blocks.values())


@pytest.mark.parametrize("block", [50_000, 2_400])
def test_small_sources_beside_a_hot_one(spark, block):
    ready(spark)
    rows = [(k, "w " * 500, "hot") for k in range(200)] + [(300 + k, "x " * 45, "mid") for k in range(40)]
    rows += [(400, "a b c d e f g", "tiny"), (401, "one", "least"), (402, "a b c", None), (403, "", "none")]
    rows += [(500 + k, "y " * 11, f"z{k % 7}") for k in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mixture.taken(df, block=block).collect(), 0.5)
    placed, pieces = mixture.full_mix(df, block=block)
    pieces = pieces.collect()
    targets = {r["nth"]: r["target"] for r in placed.collect()}
    assert {p["nth"] for p in pieces} == {n for n, t in targets.items() if t > 0}
    # A slot holds one block only.
    assert len({(p["slot"], p["nth"], p["block"]) for p in pieces}) == len({p["slot"] for p in pieces})


def test_slots_follow_the_shares(spark):
    ready(spark)
    targets = spark.createDataFrame([(0, 50.0), (1, 0.0), (2, 30.0), (3, 20.0)], "nth long, target double")
    rows = sorted(tuple(r) for r in mixture.schedule(spark, targets, 10_000).collect())
    assert [r[0] for r in rows] == list(range(10_000))
    seen = Counter()
    for slot, nth, block in rows:
        assert block == seen[nth]
        seen[nth] += 1
        for s, share in ((0, 0.5), (2, 0.3), (3, 0.2)):
            assert abs(seen[s] - share * (slot + 1)) < 8


def plain_order(sizes, targets, block, points):
    """The source of each slot, from the definition: golden-ratio points through the cumulative targets."""
    order = [s for s in sorted(sizes, key=lambda s: (s is None, (s or "").encode())) if targets[s] > 0]
    total = sum(targets[s] for s in order)
    ends, at = [], 0.0
    for s in order:
        at += targets[s]
        ends.append((at / total, s))
    return [next((s for end, s in ends if (k + 0.5) * 0.6180339887498949 % 1.0 < end), order[-1]) for k in range(points)]


def test_the_schedule_places_the_documents(spark, monkeypatch):
    """Each slot's words belong to the source that its golden-ratio point falls to; another schedule shows."""
    ready(spark)
    rows = [(k, "w " * (3 + k % 7), f"s{k % 5}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixture.taken(df, block=20).collect()
    sizes, targets = Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
    points = -(-sum(targets.values()) // 20)
    plan = plain_order(sizes, targets, 20, int(points))
    dealt = [r for r in out if r["first_slot"] is not None and r["first_slot"] < points]
    assert len(dealt) > 350 and all(plan[r["first_slot"]] == r["source"] for r in dealt)
    assert all((r["slots"] > 0) == (r["taken"] > 0) == (r["first_slot"] is not None) for r in out)
    # Every stretch of the mix holds the sources in proportion.
    for low in range(0, len(plan) - 40, 40):
        share = Counter(plan[low : low + 40])
        assert all(abs(share[s] - 40 * targets[s] / sum(targets.values())) < 5 for s in targets)
    late = sum(r["first_slot"] is not None and r["first_slot"] >= points for r in out)
    assert late < 40
    real = mixture.schedule
    monkeypatch.setattr(mixture, "schedule", lambda *a: real(*a).withColumn("nth", F.lit(0).cast("long")).withColumn("block", F.col("slot")))
    wrong = mixture.taken(df, block=20).collect()
    assert {(r["doc_id"], r["first_slot"]) for r in wrong} != {(r["doc_id"], r["first_slot"]) for r in out}
    assert sum(r["first_slot"] is not None and r["first_slot"] >= points for r in wrong) > 4 * late


def test_empty(spark):
    ready(spark)
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture.taken(df).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["taken"], r["target"]) for r in mixture.taken(nothing).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
