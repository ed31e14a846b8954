"""Block search against all distances."""

from __future__ import annotations

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tripweave.llm import nearest
from tripweave.llm.common import ready

SF = "/root/testdata/sf0.001"


def brute(rows, k):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = []
    for i, v in good:
        if i % 10 == 0:
            near = sorted((float(np.linalg.norm(np.array(v) - np.array(w))), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    return sorted(out)


def run(spark, rows, k=3, kind="float"):
    ready(spark)
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, score string")
    return sorted(tuple(r) for r in nearest.nearest(df, k, F.col("vec_id") % 10 == 0).collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-12)


def test_against_sql(spark):
    con = connect(SF)
    assert differences(nearest.op5_nearest(spark, SF), con.sql(nearest.OP5_SQL)) is None


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 7)])
def test_against_all_distances(spark, monkeypatch, blocks):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(nearest, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(1)
    vectors = np.float32(rng.normal(size=(120, 16)) * 10.0 ** rng.integers(-3, 4, size=(120, 1)))
    vectors[50:80] = vectors[50]  # ties
    rows = [(k, v.tolist(), "s") for k, v in enumerate(vectors)]
    rows += [(200, None, "s"), (210, [], "s"), (220, [0.0] * 16, "s"), (230, [float("nan")] * 16, "s"), (240, [None] + [1.0] * 15, "s"),
             (250, [1.0, 2.0], "s"), (251, [1.0, 3.0], "s"), (None, [1.0] * 16, "s"), (60, vectors[50].tolist(), "s"), (260, [float("inf")] + [0.0] * 15, "s")]
    same(run(spark, rows), brute([r[:2] for r in rows], 3))


def test_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(10, [1.0, 0.0], "s")]) == []
    same(run(spark, [(10, [1.0, 0.0], "s"), (11, [0.0, 1e-45], "s")], 5, "double"), [(10, 1, 11, 1.0)])


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 8)) * 10.0 ** rng.integers(-6, 7, size=(50, 1))
    q, s, e = nearest.quantise(x)
    assert np.allclose(np.linalg.norm(x - q * s[:, None], axis=1), e) and (e <= s * np.sqrt(8) / 2 + 1e-300).all()
