"""Exact top-k by inner product with vector-approximation files: bounds from quantised cells, then exact vectors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a dimension, and the rows of a block of vectors and of queries that one task compares.
CELLS, VECTOR_BLOCK, QUERY_BLOCK = 256, 8192, 2048
#: Exact vectors read at a time, in the order of their bounds.
READ = 64
_SCORE = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Neither null nor with components that are null or not finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce(~F.exists(vector, odd), F.lit(False))


def _matrix(rows: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component; shorter vectors are filled up with zeros."""
    out = np.zeros((len(rows), width))
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return np.floor(scale * out)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond 63 bits become the largest or smallest long."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    exact = whole(a).dot(whole(b).T)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class ApproximationFile:
    """Quantised cells of a block of vectors: per dimension, equal parts of the range, at most 256, and the one-byte code of
    the part a component is in. The bounds need nothing else of a vector than its codes."""

    def __init__(self, exact: np.ndarray, cells: int = CELLS) -> None:
        self.cells = cells
        self.low = exact.min(axis=0)
        self.width = np.maximum((exact.max(axis=0) - self.low) / cells, 1e-300)
        self.codes = np.clip((exact - self.low) / self.width, 0, cells - 1).astype(np.uint8)
        self.far = np.abs(exact).max(axis=0)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, the least inner product that each vector's cells allow, and how far the greatest lies above it.

        A cell begins at its dimension's lowest value plus code times width, so the products of all beginnings are one
        product with the codes, and the distance is the same for every vector.
        """
        step = queries * self.width
        gap = np.abs(step).sum(axis=1)
        unit = np.maximum(np.abs(step).max(axis=1), 1e-300)[:, None]
        coded = (step / unit).astype(np.float32) @ self.codes.astype(np.float32).T
        low = coded * unit + (queries @ self.low + np.minimum(step, 0).sum(axis=1))[:, None]
        # single precision, and rounding that puts a component just outside its cell
        slack = (len(self.low) + 4) * 2.0**-23 * self.cells * gap + 1e-9 * (np.abs(queries) @ self.far) + 1e-6
        return low - slack[:, None], gap + 2 * slack


def search(ids: np.ndarray, exact: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, cells: int = CELLS) -> list[tuple[int, int, int]]:
    """The k best (query, vector, score) of each query in a block; ties go to smaller ids.

    Vectors whose upper bound is under the k-th best lower bound are out. The others are read in the order of their
    upper bounds, until the k-th best score is above all that are left.
    """
    found: list[tuple[int, int, int]] = []
    file = ApproximationFile(exact, cells)
    for at in range(0, len(queries), 256):
        names = query_ids[at : at + 256]
        low, gap = file.bounds(queries[at : at + 256])
        low[names[:, None] == ids[None, :]] = -math.inf
        # with k vectors at most none is ruled out; -inf for the own ones then keeps all others
        floor = np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(names), -math.inf)
        for name, query, least, up, bar in zip(names, queries[at : at + 256], low, gap, floor, strict=True):
            order = np.flatnonzero(least >= max(bar - up, -1.7e308))  # above -inf, the own ones
            most = least[order] + up
            sequence = np.argsort(-most, kind="stable")
            order, most = order[sequence], most[sequence]
            best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
            for begin in range(0, len(order), READ):
                part = order[begin : begin + READ]
                if len(best) >= k and most[begin] < best[k - 1]:
                    break
                best = np.concatenate([best, _products(query[None, :], exact[part])[0]])
                best_ids = np.concatenate([best_ids, ids[part]])
                top = np.lexsort((best_ids, -best.astype(np.float64) if np.abs(best).max() < 2**53 else [-int(x) for x in best]))[:k]
                best, best_ids = best[top], best_ids[top]
            found += [(int(name), int(i), int(s)) for i, s in zip(best_ids, best, strict=True)]
    return found


def top_k(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row that ``queries`` selects, the k best other rows by inner product of floor(scale * x): (query_id, rank,
    vec_id, score).

    Vectors and queries are dealt to blocks by their place in the table, so no key can make one large; each block of
    vectors meets each block of queries in one task, which returns k rows a query. Unusable vectors and null ids
    take no part. Shorter vectors count as filled up with zeros. Rows with the query's id are its own and left out;
    a repeated query id is asked once, with its smallest vector; repeated rows can all be results. Tables without
    queries or vectors give no rows.
    """
    rows = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asked"))
    asked = rows.filter("asked").groupBy("id").agg(F.min("v").alias("v"))
    n, n_asked = rows.agg(F.count("*"), F.count_if("asked")).first()
    blocks, asked_blocks = max(1, math.ceil(n / VECTOR_BLOCK)), max(1, math.ceil(n_asked / QUERY_BLOCK))
    deal = lambda count: F.pmod(F.monotonically_increasing_id(), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    stored_side = rows.select(deal(blocks).alias("block"), every(asked_blocks).alias("asked_block"), F.lit(False).alias("query"), "id", "v")
    query_side = asked.select(every(blocks).alias("block"), F.pmod(F.xxhash64("id"), F.lit(asked_blocks)).cast("int").alias("asked_block"), F.lit(True).alias("query"), "id", "v")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["query"].to_numpy(dtype=bool)
        out: list[tuple[int, int, int]] = []
        if is_query.any() and not is_query.all():
            width = max(1, int(group["v"].map(len).max()))
            ids = group["id"].to_numpy(dtype=np.int64)
            exact = _matrix(group["v"], width, scale)
            out = search(ids[~is_query], exact[~is_query], ids[is_query], exact[is_query], k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    best = stored_side.union(query_side).groupBy("block", "asked_block").applyInPandas(run, _SCORE)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
