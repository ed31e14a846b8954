"""Components kept up to date equal components made anew."""

from __future__ import annotations

import random

import pytest

from tripweave.operators.components import components, pair_changes, updated_components


def plain(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in pairs:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def labels_of(df):
    return {r["node"]: r["component"] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_days(spark, seed):
    pick = random.Random(seed)
    node = lambda: f"n{pick.randrange(60):02d}"
    pairs = {(a, b) for a, b in ((node(), node()) for _ in range(30)) if a != b}
    frame = lambda rows: spark.createDataFrame(sorted(rows), "u string, v string")
    labels, before = components(frame(pairs)), frame(pairs)
    for _ in range(2):
        pairs = {p for p in pairs if pick.random() < 0.8} | {(a, b) for a, b in ((node(), node()) for _ in range(6)) if a != b}
        now = frame(pairs)
        labels, before = updated_components(labels, now, *pair_changes(before, now)), now
        assert labels_of(labels) == plain(pairs)


def test_untouched_components_take_no_part(spark):
    frame = lambda rows: spark.createDataFrame(rows, "u string, v string")
    old = [(f"a{k}", f"b{k}") for k in range(50)]
    labels, now = components(frame(old)), frame([*old, ("b1", "b2")])
    added, removed = pair_changes(frame(old), now)
    assert [tuple(r) for r in added.collect()] == [("b1", "b2")] and removed.isEmpty()
    out = labels_of(updated_components(labels, now, added, removed))
    assert {n for n, c in out.items() if c == "a1"} == {"a1", "b1", "a2", "b2"} and len(out) == 100


def test_last_pair_goes_and_nothing_is_left(spark):
    frame = lambda rows: spark.createDataFrame(rows, "u string, v string")
    labels = components(frame([("a", "b"), ("b", "c"), ("x", "y")]))
    now = frame([("b", "c")])
    out = updated_components(labels, now, *pair_changes(frame([("a", "b"), ("b", "c"), ("x", "y")]), now))
    assert labels_of(out) == {"b": "b", "c": "b"}
    none = frame([])
    assert labels_of(updated_components(out, none, *pair_changes(now, none))) == {}
