"""One row per near-duplicate key, however the rows come."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripweave.operators.dedupe import first_rows
from tripweave.sources.first_seen import FirstSeenTable, near_key

SHAPE = "id string, who string, what string, at string, v bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE).withColumn("at", F.col("at").cast("timestamp"))


def made(seed, n=60):
    pick = random.Random(seed)
    rows = []
    for k in range(n):
        at = pick.choice([None, *[f"2026-{m:02d}-0{d} 08:00:00" for m in (1, 2, 3, 4) for d in (1, 5)]])
        rows.append((f"b{k:03d}", pick.choice(["x", "y", None, ""]), pick.choice(["p", "q", None]), at, pick.choice([1, 2, None])))
    return rows


KEY = lambda: [F.col("who"), F.lower("what"), F.col("v")]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_equals_one_run(spark, tmp_path, seed):
    rows = made(seed)
    every = frame(spark, rows)
    want = sorted(map(str, first_rows(every, KEY(), [F.col("id").asc()]).collect()))
    random.Random(seed).shuffle(rows)
    table = FirstSeenTable(spark, str(tmp_path), "id", "at", every.schema)
    for low in (0, 20, 40, 20):
        table.add(frame(spark, rows[low : low + 20]), KEY())
    assert sorted(map(str, table.read().collect())) == want
    # Every row is kept or listed, none both ways.
    kept, others = {r["id"] for r in table.read().collect()}, [r["id"] for r in table.others.read().collect()]
    assert kept | set(others) == {r[0] for r in rows} and len(kept) + len(others) == len(rows)


def test_a_late_row_with_a_lower_id_takes_over(spark, tmp_path):
    schema = frame(spark, []).schema
    table = FirstSeenTable(spark, str(tmp_path), "id", "at", schema)
    table.add(frame(spark, [("b5", "x", "p", "2026-06-01", 1)]), KEY())
    table.add(frame(spark, [("b9", "x", "P", "2026-07-01", 1)]), KEY())
    table.add(frame(spark, [("b1", "x", "p", "2025-01-01", 1)]), KEY())
    assert [r["id"] for r in table.read().collect()] == ["b1"]
    assert sorted(r["id"] for r in table.others.read().collect()) == ["b5", "b9"]


def test_missing_parts_of_a_key(spark):
    df = frame(spark, [("1", None, "p", None, 1), ("2", "", "p", None, 1), ("3", None, "p", None, 1), ("4", "-", "p", None, 1), ("5", "=", None, None, 1)])
    keys = {r["id"]: r["k"] for r in df.select("id", near_key(KEY()).alias("k")).collect()}
    assert keys["1"] == keys["3"] and len(set(keys.values())) == 4


def test_rows_without_an_id_and_empty_batches(spark, tmp_path):
    schema = frame(spark, []).schema
    table = FirstSeenTable(spark, str(tmp_path), "id", "at", schema)
    table.add(frame(spark, []), KEY())
    table.add(frame(spark, [("b1", "x", "p", "2026-01-01", 1), (None, "x", "p", "2026-02-01", 1), (None, "y", "p", None, 1)]), KEY())
    # As in one run: a missing id comes first.
    assert sorted(str(r["id"]) for r in table.read().collect()) == ["None", "None"]
    assert [r["id"] for r in table.others.read().collect()] == ["b1"]
