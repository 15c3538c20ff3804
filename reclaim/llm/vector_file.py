"""Operator 12: centroid clustering over a VA-file.

Every kept vector (all ``dim`` components finite) becomes integers
``floor(scale * x)``.  One pass writes two files: the *vector files* hold the
integers, row by row, and a Parquet table holds for each vector its place and
its *approximation*, one few-bit cell per dimension.  The marks between cells
are quantiles of each dimension, so dense ranges get narrow cells.

A scan for some centroids reads approximations only.  A lookup table for each
centroid and dimension gives the least and greatest share that a cell can have
in the squared distance; added up over the dimensions they are an interval for
each centroid (of the distance less the vector's own squared length, which is
the same for all centroids and would only widen them).  A vector goes to the
centroid whose interval lies under all others.  Only where intervals overlap
the full vector is fetched from its file, and compared with the overlapping
centroids by exact integers.

A round needs the sums of its clusters.  Sums follow from those of the round
before by the vectors that moved: one scan finds the cluster of a vector for
the old and for the new centroids, and fetches the moved ones.  So a round
writes nothing, keeps no state beside k sums, and a lost task is just run again.

Files belong to the task that wrote them: a task that is run again writes under
another name, and only the places in the table that Spark committed are read.
The files and the table are deleted when the result has been written.

Cases: vectors that are null, of another length, or with a null, NaN or infinite
component take no part; a null vec_id takes part, but starts a centroid only if
fewer than k others are there; repeated rows count each (equal hashes start in
the order of their vectors); ties go to the smaller centroid number; with fewer
than k vectors there are as many centroids; an empty table gives no rows.
Integers of 2^27 and more raise an error, because a distance would not fit into
a long.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_tables, ensure_checkpoint_dir, materialize
from .common import tidy
from .warc import store

K, ROUNDS, SEED = 8, 10, 3
SCALE, DIM = 1024.0, 64
BITS = 6  # of a cell
LARGEST = 1 << 27
STEP = 4096  # vectors compared at once
GAP = 32  # vectors between two wanted ones that are read along with them
ACCURACY = 2000  # of the quantiles: rank error 1 / ACCURACY
PLACES = "path string, place long, vec_id long, cells binary"


def integers(vectors: DataFrame, dim: int = DIM, scale: float = SCALE) -> DataFrame:
    """vec_id and the integer vector v of every kept row."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.where(e.isNotNull() & (F.size(e) == dim)).where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v")
    )


def start_hash(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def marks_of(kept: DataFrame, dim: int, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Least and greatest integer of each cell, by dimension; None without
    vectors.  The outer cells reach to the exact minimum and maximum."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    of = [F.element_at("v", d + 1) for d in range(dim)]
    row = kept.agg(*(F.min(x) for x in of), *(F.max(x) for x in of), *(F.percentile_approx(x, shares, ACCURACY) for x in of)).first()
    if row[0] is None:
        return None
    least, most = np.array(row[:dim], object), np.array(row[dim : 2 * dim], object)
    if min(least) <= -LARGEST or max(most) >= LARGEST:
        raise ValueError(f"scaled components must lie between -{LARGEST} and {LARGEST}")
    inner = np.array(row[2 * dim :], np.int64)
    low = np.concatenate([least[:, None], inner + 1], 1).astype(np.int64)
    high = np.concatenate([inner, most[:, None]], 1).astype(np.int64)
    return low, np.maximum(high, low)  # a cell between equal marks stays empty


def cells_of(v: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Cell of each component: the number of inner marks under it."""
    out = np.empty(v.shape, np.uint8)
    for d in range(v.shape[1]):
        out[:, d] = np.searchsorted(high[d, :-1], v[:, d], side="left")
    return out


def vectors_in(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def build(kept: DataFrame, folder: str, high: np.ndarray, dim: int) -> DataFrame:
    """Write the vector files; one row per vector with its place and cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        out, path, place = None, "", 0
        for batch in batches:
            v = vectors_in(batch, 1, dim)
            if not len(v):
                continue
            if out is None:
                files.create_dir(root, recursive=True)
                path = f"{root}/{uuid.uuid4().hex}.vectors"
                out = files.open_output_stream(path)
            out.write(v.astype("<i4").tobytes())
            cells = cells_of(v, high)
            ends = np.arange(len(v) + 1, dtype=np.int32) * dim
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * len(v)),
                    pa.array(np.arange(place, place + len(v))),
                    batch.column(0),
                    pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(ends), pa.py_buffer(cells.tobytes())]),
                ],
                ["path", "place", "vec_id", "cells"],
            )
            place += len(v)
        if out is not None:
            out.close()

    return kept.mapInArrow(tidy(run), PLACES)


class Fetcher:
    """Reads full vectors at their places; neighbours are read together."""

    def __init__(self, folder: str, dim: int):
        self.files, _ = store(folder)
        self.dim, self.path, self.file = dim, None, None

    def __call__(self, paths: pa.Array, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), self.dim), np.int64)
        names = paths.take(pa.array(rows)).dictionary_encode()
        code = names.indices.to_numpy()
        for c, path in enumerate(names.dictionary.to_pylist()):
            mine = np.flatnonzero(code == c)
            at = places[rows[mine]]
            order = np.argsort(at, kind="stable")
            mine, at = mine[order], at[order]
            for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > GAP) + 1):
                first, last = int(at[run[0]]), int(at[run[-1]])
                out[mine[run]] = self.read(path, first, last + 1 - first)[at[run] - first]
        return out

    def read(self, path: str, first: int, n: int) -> np.ndarray:
        if path != self.path:
            self.close()
            self.path, self.file = path, self.files.open_input_file(path)
        width = 4 * self.dim
        return np.frombuffer(self.file.read_at(n * width, first * width), "<i4").reshape(n, self.dim)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.path = self.file = None


class Tables:
    """Lookup tables of some centroids: the interval of each cell."""

    def __init__(self, centroids: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.c = centroids
        a, b = -2 * centroids[:, :, None] * low[None], -2 * centroids[:, :, None] * high[None]
        self.least = np.minimum(a, b).transpose(1, 2, 0).copy()  # dimension, cell, centroid
        self.most = np.maximum(a, b).transpose(1, 2, 0).copy()
        self.own = (centroids * centroids).sum(1)

    def overlapping(self, cells: np.ndarray) -> np.ndarray:
        """Whether each centroid may be the nearest one of each vector."""
        least = np.repeat(self.own[None], len(cells), 0)
        most = least.copy()
        for d in range(cells.shape[1]):
            least += self.least[d][cells[:, d]]
            most += self.most[d][cells[:, d]]
        return least <= most.min(1, keepdims=True)

    def nearest(self, v: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid among the overlapping ones (ties: smaller number)
        and its squared distance."""
        apart = np.full(may.shape, np.iinfo(np.int64).max)
        for c in range(len(self.c)):
            rows = np.flatnonzero(may[:, c])
            gap = v[rows] - self.c[c]
            apart[rows, c] = np.einsum("ij,ij->i", gap, gap)
        best = apart.argmin(1)
        return best, apart[np.arange(len(v)), best]


@dataclass
class VaFile:
    """The approximations of some vectors and where the vectors are."""

    folder: str
    places: DataFrame
    low: np.ndarray
    high: np.ndarray
    made: list[str]

    @property
    def dim(self) -> int:
        return len(self.low)

    def moves(self, new: np.ndarray, old: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Change of each cluster's vector count and sums from the old
        centroids (None: no clusters yet) to the new ones, and the number of
        vectors fetched."""
        k, dim, folder, low, high = len(new), self.dim, self.folder, self.low, self.high

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fetch, tables = Fetcher(folder, dim), [Tables(c, low, high) for c in ([new] if old is None else [new, old])]
            counts, sums, fetched = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), 0
            for whole in batches:
                for at in range(0, whole.num_rows, STEP):
                    batch = whole.slice(at, STEP)
                    cells = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, dim)
                    may = [t.overlapping(cells) for t in tables]
                    clusters = [m.argmax(1) for m in may]
                    open_ = np.logical_or.reduce([m.sum(1) > 1 for m in may])
                    wanted = np.ones(len(cells), bool) if old is None else open_ | (clusters[0] != clusters[1])
                    rows = np.flatnonzero(wanted)
                    if not len(rows):
                        continue
                    fetched += len(rows)
                    v = fetch(batch.column(0), batch.column(1).to_numpy(), rows)
                    found = [t.nearest(v, m[rows])[0] for t, m in zip(tables, may)]
                    moved = np.ones(len(rows), bool) if old is None else found[0] != found[1]
                    for sign, place in zip((1, -1), found):
                        for c in np.unique(place[moved]).tolist():
                            of = v[moved & (place == c)]
                            counts[c] += sign * len(of)
                            sums[c] += sign * of.sum(0)
            fetch.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k)), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64())), pa.array([fetched] + [0] * (k - 1), pa.int64())],
                ["cluster", "n", "total", "fetched"],
            )

        parts = self.places.select("path", "place", "cells").mapInArrow(tidy(run), "cluster long, n long, total array<long>, fetched long")
        exact = F.posexplode("total").alias("d", "x")
        table = parts.select("cluster", "n", "fetched", exact).groupBy("cluster", "d").agg(
            F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("fetched").alias("fetched")
        )
        counts, sums, fetched = np.zeros(k, object), np.zeros((k, dim), object), 0
        for r in table.collect():  # k * dim rows
            counts[r.cluster], sums[r.cluster, r.d] = r.n, int(r.x)
            fetched += r.fetched if r.d == 0 else 0
        return counts, sums, fetched

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """vec_id, cluster and exact squared distance of every vector; the
        distance needs the full vector, the intervals choose what it is
        compared with."""
        dim, folder, low, high = self.dim, self.folder, self.low, self.high

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fetch, tables = Fetcher(folder, dim), Tables(centroids, low, high)
            for whole in batches:
                for at in range(0, whole.num_rows, STEP):
                    batch = whole.slice(at, STEP)
                    cells = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, dim)
                    v = fetch(batch.column(0), batch.column(1).to_numpy(), np.arange(len(cells)))
                    cluster, distance = tables.nearest(v, tables.overlapping(cells))
                    yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])
            fetch.close()

        return self.places.mapInArrow(tidy(run), "vec_id long, cluster int, distance long")


def va_file(kept: DataFrame, dim: int = DIM, bits: int = BITS) -> VaFile | None:
    """Write the VA-file of integer vectors (vec_id, v); None without any."""
    spark = kept.sparkSession
    cells = marks_of(kept, dim, bits)
    if cells is None:
        return None
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reclaim-vectors/{uuid.uuid4().hex}"
    made = [folder]
    places = materialize(build(kept, folder, cells[1], dim), "llm-va-file", made)
    return VaFile(folder, places, *cells, made)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: float = SCALE, bits: int = BITS, log: list[int] | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256
    of every kept vector.  ``log`` gets the vectors fetched in each round."""
    spark = vectors.sparkSession
    kept = integers(vectors, dim, scale)
    first = kept.orderBy(start_hash(seed).asc_nulls_last(), "v").limit(k).collect()
    file = va_file(kept, dim, bits) if first else None
    if file is None:
        return spark.createDataFrame([], RESULT)
    new, old = np.array([r.v for r in first], np.int64), None
    counts, sums = np.zeros(len(new), object), np.zeros((len(new), dim), object)
    for _ in range(rounds):
        more, total, fetched = file.moves(new, old)
        counts, sums, old = counts + more, sums + total, new
        if log is not None:
            log.append(fetched)
        new = np.array([[s // n for s in row] if n else c.tolist() for row, n, c in zip(sums, counts, old)], np.int64)
        if (new == old).all():  # nothing moves any more
            break
    found = materialize(file.assigned(new), "llm-clusters")
    delete_tables(spark, file.made)
    return with_inertia(spark, found, new)


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def with_inertia(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    total = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, total.get(c, 0), sum(total.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    sizes = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return found.join(F.broadcast(sizes), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = int(SCALE)) -> str:
    """The same by plain distances of every vector to every centroid."""
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, e) - 1 AS cluster, e AS c
  FROM v QUALIFY cluster < {k}
)"""]
    near = """, a{i} AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (SELECT r, cluster, list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i})
  GROUP BY r
)"""
    mean = """, m{j} AS (
  SELECT cluster, i, sum(e[i]) AS s, count(*) AS n
  FROM a{i} JOIN v USING (r), range(1, {dim} + 1) AS t(i) GROUP BY cluster, i
), c{j} AS MATERIALIZED (
  SELECT cluster, coalesce(w, c) AS c
  FROM c{i} LEFT JOIN (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM m{j} GROUP BY cluster) USING (cluster)
)"""
    for i in range(rounds):
        steps += [near.format(i=i), mean.format(i=i, j=i + 1, dim=dim)]
    return "".join(steps) + near.format(i=rounds) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (cluster)
"""
