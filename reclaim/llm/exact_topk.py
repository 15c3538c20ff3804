"""Operator 3: exact top-k inner-product search by Fagin's threshold algorithm.

Vectors are dealt by hash to candidate blocks, queries to query blocks; each
(candidate block, query block) pair is one group.  A group keeps, for every
dimension, its candidates sorted by component.  A query walks all lists in
step, from the end its own component favours, scores what it meets for the
first time by random access and stops as soon as the bound (the score of a
vector made of the components at the current depth) cannot reach the kth best
score.  Vectors equal to the bound may still win a tie, so it stops only below.
The block results are reduced to the k best per query by a group limit.

Cases: null vectors and vectors with null, NaN or infinite components take no
part; a row repeated with an equal vector counts once; rows with the query's
vec_id are its own; shorter vectors count as padded with zeros; rows with a
null vec_id take no part; ties go to the smaller vec_id; fewer candidates than
k give all; extra columns are ignored; an empty table gives no rows.
Components are longs: scores must stay below 2**63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions

BLOCK = 16384  # candidates of a block
QUERIES = 512  # queries of a block
DEPTH = 256  # list entries read before the bound is first tested


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, v): components floor(scale * x) of the vectors that take part."""
    x = F.col(vec_col)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return (
        df.where(F.col(id_col).isNotNull() & x.isNotNull() & whole)
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("v"))
        .distinct()
    )


def matrix(table: pa.Table, width: int) -> np.ndarray:
    """Rows of column v as an integer matrix, padded with zeros."""
    column = table.column("v").combine_chunks()
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    size = np.diff(ends)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = flat[ends[0] : ends[-1]]
    return out


def threshold_top(lists: np.ndarray, values: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(vec_ids, scores) of the k best candidates for one query.  lists:
    candidates of each dimension by falling component; values: those components."""
    n = len(ids)
    used = np.flatnonzero(query)
    weight = query[used]
    up = weight > 0
    met = ids == own
    best_id, best = np.zeros(0, np.int64), np.zeros(0, vectors.dtype)
    depth = 0
    step = DEPTH
    while depth < n:
        end = min(n, depth + step)
        met_now = np.zeros(n, bool)
        # Sorted access: the next entries of every list.
        met_now[lists[used[up], depth:end].ravel()] = True
        met_now[lists[used[~up], n - end : n - depth].ravel()] = True
        if not len(used):
            met_now[:] = True
        new = np.flatnonzero(met_now & ~met)
        met |= met_now
        if len(new):
            # Random access: whole scores of candidates met for the first time.
            score = vectors[new] @ query
            best_id, best = np.concatenate([best_id, ids[new]]), np.concatenate([best, score])
            if len(best) > k:
                kth = np.partition(best, len(best) - k)[len(best) - k]
                keep = best >= kth
                best_id, best = best_id[keep], best[keep]
                order = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[order], best[order]
        depth, step = end, step * 2
        if depth == n or not len(used) or met.all():
            break
        bound = weight[up] @ values[used[up], depth - 1] + weight[~up] @ values[used[~up], n - depth]
        if len(best) >= k and bound < best[-1]:
            break
    order = np.lexsort((best_id, -best))[:k]
    return best_id[order], best[order]


def search(df: DataFrame, is_query: Column, k: int, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every
    row that satisfies ``is_query`` (a condition on vec_id)."""
    vectors = integer_vectors(df, id_col, vec_col, scale)
    n, n_queries, width = vectors.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(F.size("v"))).first()
    blocks, sets = max(1, -(-n // block)), max(1, -(-n_queries // queries))
    width = max(1, width or 0)
    deal = lambda parts, salt: F.pmod(F.xxhash64(F.col("vec_id"), F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    candidates = vectors.withColumn("cb", deal(blocks, 0)).withColumn("qb", every(sets))
    asked = vectors.where(is_query).withColumn("qb", deal(sets, 1)).withColumn("cb", every(blocks))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("vec_id").to_numpy()
        rows = matrix(right, width)
        asked_ids, asked_rows = left.column("vec_id").to_numpy(), matrix(left, width)
        # Floats add exactly while all sums fit their mantissa; otherwise stay with integers.
        most = width * float(np.abs(rows).max(initial=0)) * float(np.abs(asked_rows).max(initial=0))
        if most < 2.0**52:
            kind = np.float32 if most < 2.0**23 else np.float64
            rows, asked_rows = rows.astype(kind), asked_rows.astype(kind)
        order = np.argsort(-rows, axis=0, kind="stable").T.astype(np.int32)
        lists, values = np.ascontiguousarray(order), np.take_along_axis(np.ascontiguousarray(rows.T), order, 1)
        found = [threshold_top(lists, values, rows, ids, q, own, k) for own, q in zip(asked_ids, asked_rows)]
        return pa.table(
            {
                "query_id": pa.array(np.repeat(asked_ids, [len(x) for x, _ in found]), pa.int64()),
                "vec_id": pa.array(np.concatenate([x for x, _ in found] or [np.zeros(0, np.int64)]), pa.int64()),
                "score": pa.array(np.concatenate([s for _, s in found] or [np.zeros(0)]).astype(np.int64), pa.int64()),
            }
        )

    spread = lambda d: d.repartition(partitions(blocks * sets), "cb", "qb").groupBy("cb", "qb")
    local = spread(asked).cogroup(spread(candidates)).applyInArrow(run, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
