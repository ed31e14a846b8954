"""The index of keys and months: nothing missed, little read."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tripweave.sources import key_index
from tripweave.sources.key_index import KeyIndex
from tripweave.sources.tables import MonthlyTable, delete_path


def pairs(spark, rows):
    return spark.createDataFrame(rows, "key string, month string")


def found(index, spark, keys):
    return sorted(tuple(r) for r in index.months_of(spark.createDataFrame([(k,) for k in keys], "key string")).collect())


def test_no_key_is_missed(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), 4)
    assert not index.exists()
    index.rebuild(pairs(spark, [(f"k{n}", f"2026-{1 + n % 9:02d}") for n in range(3_000)] + [(None, "2026-01")]))
    assert index.exists()
    asked = [f"k{n}" for n in range(0, 3_000, 7)]
    assert found(index, spark, [*asked, "other", None]) == sorted((f"k{n}", f"2026-{1 + n % 9:02d}") for n in range(0, 3_000, 7))
    others = spark.createDataFrame([(f"x{n}",) for n in range(5_000)], "key string")
    assert index.candidates(others).count() < 250


def test_added_and_moved_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), 2)
    index.rebuild(pairs(spark, [("a", "2026-01"), ("b", "2026-02")]))
    new = pairs(spark, [("b", "2026-02"), ("a", "2026-03"), ("c", "2026-04"), ("a", "2026-03")]).distinct()
    for _ in range(2):
        index.add(new, index.months_of(new))
    assert found(index, spark, "abcd") == [("a", "2026-01"), ("a", "2026-03"), ("b", "2026-02"), ("c", "2026-04")]


def test_filters_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "LEAST_WORDS", 1)
    index = KeyIndex(spark, str(tmp_path / "i"), 2)
    index.rebuild(pairs(spark, [("a", "m")]))
    before = index._words()
    for turn in range(3):
        more = pairs(spark, [(f"k{turn}-{n}", "m") for n in range(60)])
        index.add(more, index.months_of(more))
    assert index._words() > before and len(list(tmp_path.glob("i/filter-*"))) == 1
    assert len(found(index, spark, [f"k{t}-{n}" for t in range(3) for n in range(60)])) == 180


def test_a_lost_filter_write_is_not_used(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), 2)
    index.rebuild(pairs(spark, [("a", "m")]))
    (tmp_path / "i" / f"filter-{2 * index._words()}").mkdir()
    assert found(index, spark, ["a"]) == [("a", "m")]


def months(spark, path, rows, buckets=64):
    df = spark.createDataFrame(rows, "k string, at string, v bigint").withColumn("at", F.col("at").cast("timestamp"))
    return df, MonthlyTable(spark, path, "k", "at", df.schema, buckets)


def test_untouched_buckets_and_months_are_not_read(spark, tmp_path):
    rows = [(f"k{n}", f"2026-{1 + n % 12:02d}-05", n) for n in range(600)]
    first, table = months(spark, str(tmp_path / "t"), rows)
    table.upsert(first)
    batch, _ = months(spark, str(tmp_path / "t"), [("k0", "2026-03-09", 1), ("k13", "2026-03-09", 2), ("new", "2026-03-09", 3)])
    keys = batch.select(F.col("k").alias("key"))
    index = table.index
    read = index.months_of(keys)
    plan = read._jdf.queryExecution().executedPlan().toString()
    buckets = {r["bucket"] for r in index.candidates(keys).collect()}
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "month" in line)
    assert 2 <= len(buckets) <= 4
    assert re.search(rf"PartitionFilters: \[bucket#\d+ IN \({','.join(map(str, sorted(buckets)))}\)", scan)
    # k0 comes from January and k13 from February; no other month is touched.
    assert table.touched_months(batch) == ["2026-01", "2026-02", "2026-03"]
    before = {m: sorted(p.name for p in (tmp_path / "t" / f"stored_month=2026-{m:02d}").iterdir()) for m in range(1, 13)}
    assert table.upsert(batch) == ["2026-01", "2026-02", "2026-03"]
    after = {m: sorted(p.name for p in (tmp_path / "t" / f"stored_month=2026-{m:02d}").iterdir()) for m in range(1, 13)}
    assert {m for m in before if before[m] != after[m]} == {1, 2, 3}
    got = {r["k"]: (str(r["at"])[:7], r["v"]) for r in table.read().collect()}
    assert len(got) == table.read().count() == 601
    assert got["k0"] == ("2026-03", 1) and got["k13"] == ("2026-03", 2) and got["new"] == ("2026-03", 3)


def test_a_table_without_an_index_gets_one(spark, tmp_path):
    path = str(tmp_path / "t")
    first, table = months(spark, path, [("a", "2026-01-05", 1), (None, "2026-02-05", 2)])
    table.upsert(first)
    delete_path(spark, table.index.path)
    batch, again = months(spark, path, [("a", "2026-03-05", 3)])
    assert again.upsert(batch) == ["2026-01", "2026-03"]
    assert again.index.exists()
    again.replace_all(batch)
    assert sorted(tuple(r) for r in again.index._keys().select("key", "month").collect()) == [("a", "2026-03")]


def test_a_run_lost_between_index_and_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first, table = months(spark, path, [("a", "2026-01-05", 1), ("b", "2026-02-05", 2)])
    table.upsert(first)
    batch, again = months(spark, path, [("a", "2026-04-05", 10), ("c", "2026-04-05", 3)])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(MonthlyTable, "_prepare", die)
        with pytest.raises(RuntimeError):
            again.upsert(batch)
    assert sorted((r["k"], r["v"]) for r in table.read().collect()) == [("a", 1), ("b", 2)]
    table.upsert(batch)
    assert sorted((r["k"], r["v"]) for r in table.read().collect()) == [("a", 10), ("b", 2), ("c", 3)]


def test_a_large_batch_meets_the_stored_keys_without_the_filters(spark, tmp_path, monkeypatch):
    rows = [(f"k{n}", f"2026-{1 + n % 3:02d}-05", n) for n in range(60)] + [(None, "2026-01-05", 1)]
    first, table = months(spark, str(tmp_path / "t"), rows, 2)
    table.upsert(first)
    monkeypatch.setattr(key_index, "MOST_ASKED", 5)
    monkeypatch.setattr(KeyIndex, "candidates", lambda *_: pytest.fail("filters were asked"))
    moved = [(f"k{n}", "2026-04-05", n + 1) for n in range(0, 60, 2)] + [("new", "2026-05-05", 7), ("new", "2026-05-05", 7), (None, "2026-04-05", 2)]
    batch, again = months(spark, str(tmp_path / "t"), moved, 2)
    assert again.upsert(batch) == ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05"]
    want = {**{k: (at, v) for k, at, v in rows if k}, **{k: (at, v) for k, at, v in moved if k}}
    kept = table.read().filter("k is not null").collect()
    assert len(kept) == len(want) + 1 and {r["k"]: (str(r["at"])[:10], r["v"]) for r in kept} == want
    assert table.read().filter("k is null").count() == 2
    monkeypatch.undo()
    assert found(table.index, spark, ["k0", "k1", "new"]) == [("k0", "2026-01"), ("k0", "2026-04"), ("k1", "2026-02"), ("new", "2026-05")]


def test_a_batch_of_known_pairs_writes_nothing_to_the_index(spark, tmp_path):
    first, table = months(spark, str(tmp_path / "t"), [("a", "2026-01-05", 1), ("b", "2026-02-05", 2), (None, None, 3)])
    table.upsert(first)
    before = sorted(str(p) for p in (tmp_path / "t__index").rglob("*.parquet"))
    assert table.upsert(first) == ["2026-01", "2026-02", "none"]
    assert sorted(str(p) for p in (tmp_path / "t__index").rglob("*.parquet")) == before
