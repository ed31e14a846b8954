"""Nearest neighbours by a block matrix join.

Queries and candidates are dealt into blocks of bounded size; every query block meets every candidate block in one
tile. A vector is quantised to int8 with a scale of its own. The product of two int8 blocks gives all distances of a
tile up to the vectors' quantisation errors, hence a lower and an upper bound for each; pairs whose lower bound
exceeds the k-th smallest upper bound of their query are dropped, which loses nothing. The others are recomputed in
double precision from the original vectors, a heap keeps each query's k best of the tile, and Spark merges the tiles.

The result is exact: recall is 1. Ties go to the smaller id. Vectors that are null, empty, zero, or hold a null or
non-finite component take no part, nor do rows without an id. Repeated rows count once. Vectors of another length
than the query's are no candidates. Fewer than k candidates are all returned; an empty table gives an empty result.
Only the id and the vector are read, so further columns of any name do not matter.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import table

QUERY_BLOCK = 2_048
CANDIDATE_BLOCK = 4_096
CHUNK = 128  # queries of a tile that are compared at a time


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 components, the scale of each vector, and the length of what rounding took from it."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0  # the smallest numbers of all
    q = np.rint(x / scale[:, None])
    return q.astype(np.int8), scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1))


def tile(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, candidate_ids: np.ndarray, k: int) -> list[tuple[int, float, int]]:
    """``(position of the query, distance, candidate id)`` of each query's k nearest in the tile."""
    qa, sa, ea = quantise(queries)
    qb, sb, eb = quantise(candidates)
    dim = queries.shape[1]
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64  # products of int8 are exact in either
    right = qb.astype(kind).T
    nb = (qb.astype(np.float64) ** 2).sum(axis=1) * sb**2
    out = []
    for start in range(0, len(queries), CHUNK):
        part = slice(start, start + CHUNK)
        product = (qa[part].astype(kind) @ right).astype(np.float64)
        na = (qa[part].astype(np.float64) ** 2).sum(axis=1) * sa[part] ** 2
        near = np.sqrt(np.maximum(na[:, None] + nb[None, :] - 2 * product * sa[part][:, None] * sb[None, :], 0))
        # Rounding of the double arithmetic above is far below this.
        slack = ea[part][:, None] + eb[None, :] + 1e-6 * (np.sqrt(na)[:, None] + np.sqrt(nb)[None, :])
        own = query_ids[part][:, None] == candidate_ids[None, :]
        upper = np.where(own, np.inf, near + slack)
        limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(upper), np.inf)
        alive = (near - slack <= limit[:, None]) & ~own
        for i in range(len(upper)):
            at = np.flatnonzero(alive[i])
            gap = candidates[at] - queries[start + i]
            exact = np.sqrt((gap * gap).sum(axis=1))
            out += [(start + i, d, c) for d, c in heapq.nsmallest(k, zip(exact.tolist(), candidate_ids[at].tolist()))]
    return out


def nearest(vectors: DataFrame, k: int, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows of every row for which ``is_query`` holds."""
    rows = (
        vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"), is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    )
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).first()
    n_groups = max(1, ceil(counts["n"] / CANDIDATE_BLOCK))
    q_groups = max(1, ceil(counts["asking"] / QUERY_BLOCK))
    rows = rows.dropDuplicates(["id", "v"]).withColumn("h", F.xxhash64("id", "v"))
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = rows.filter("asks").select(
        "dim", F.pmod(F.col("h"), F.lit(q_groups)).cast("int").alias("q"), blocks(n_groups).alias("c"), "id", "h", "v"
    )
    all_rows = rows.select(
        "dim", blocks(q_groups).alias("q"), F.pmod(F.col("h"), F.lit(n_groups)).cast("int").alias("c"), "id", "v"
    )
    schema = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])

    def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
        return pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, keys = left["id"].to_numpy(), left["h"].to_numpy()
        found = tile(matrix(left["v"], left.num_rows), ids, matrix(right["v"], right.num_rows), right["id"].to_numpy(), k)
        at = np.array([f[0] for f in found], int)
        return pa.table([ids[at], keys[at], [f[1] for f in found], [f[2] for f in found]], schema=schema)

    found = (
        asking.groupBy("dim", "q", "c").cogroup(all_rows.groupBy("dim", "q", "c"))
        .applyInArrow(compare, "query_id long, query_key long, score double, vec_id long")
    )
    nth = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), 10, F.col("vec_id") % 100 == 0)


OP5_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM rows q JOIN rows c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs) WHERE rank <= 10
"""
