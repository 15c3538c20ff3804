import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reclaim.llm import vector_file as va

from cases import SF_TINY

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_version(rows, dim, k=8, rounds=10, seed=3, scale=1024.0):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in e]) for i, e in rows if e is not None and len(e) == dim and all(x is not None and np.isfinite(x) for x in e)]
    if not kept:
        return []
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = [sum(d for _, d, j in found if j == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], sum(inertia), sha[j]) for i, d, j in found), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def mixed(rng, n, dim):
    middle = rng.normal(0, 1, (5, dim))
    rows = [(i, (middle[i % 5] + rng.normal(0, 0.2, dim)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # copies
    rows += [(3, rows[7][1]), (3, rows[3][1]), (None, rows[5][1]), (n * 9, None), (n * 9 + 1, []), (n * 9 + 2, rows[1][1][:-1]), (n * 9 + 3, [None] + rows[1][1][1:]), (n * 9 + 4, [float("nan")] + rows[1][1][1:]), (n * 9 + 5, [float("-inf")] + rows[1][1][1:])]
    return rows


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_equals_plain_version(spark, bits):
    rows = mixed(np.random.default_rng(bits), 120, 6)
    docs = spark.createDataFrame([(i, e, 0) for i, e in rows], VECTORS).repartition(3)
    log = []
    got = collected(va.cluster(docs, dim=6, bits=bits, log=log))
    assert got == plain_version(rows, 6)
    assert log[0] == len(got) and (bits < 6 or log[-1] < len(got) / 2)  # later scans fetch where intervals overlap


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(0)
    v, c = rng.integers(-500, 500, (300, 7)), rng.integers(-500, 500, (4, 7))
    inner = np.sort(rng.integers(-400, 400, (7, 7)), axis=1)
    low = np.concatenate([v.min(0)[:, None], inner + 1], 1)
    high = np.maximum(np.concatenate([inner, v.max(0)[:, None]], 1), low)
    cells = va.cells_of(v, high)
    picked = np.arange(7)[None]
    assert (low[picked, cells] <= v).all() and (v <= high[picked, cells]).all()
    may = va.Tables(c, low, high).overlapping(cells)
    best = ((v[:, None] - c[None]) ** 2).sum(2).argmin(1)
    assert may[np.arange(300), best].all() and not may.all()


def test_few_equal_and_no_vectors(spark):
    one = [(5, [0.5, -0.25])]
    for rows in (one, one * 20, [(i, [1.0, 1.0]) for i in range(30)], [(1, None), (2, [])], []):
        docs = spark.createDataFrame([(i, e, 0) for i, e in rows], VECTORS)
        assert collected(va.cluster(docs, dim=2, rounds=3)) == plain_version(rows, 2, rounds=3)


def test_clashing_columns_and_too_large(spark):
    rows = mixed(np.random.default_rng(4), 40, 3)
    docs = spark.createDataFrame([(i, e, 0) for i, e in rows], VECTORS)
    clashing = docs.withColumn("cluster", F.lit("x")).withColumn("path", F.lit(1)).withColumn("v", F.lit(2)).withColumn("distance", F.lit(2))
    assert collected(va.cluster(clashing, dim=3, rounds=3)) == plain_version(rows, 3, rounds=3)
    with pytest.raises(ValueError, match="must lie between"):
        va.cluster(spark.createDataFrame([(1, [1e30, 0.0], 0)], VECTORS), dim=2)


def test_nothing_left_in_the_vector_folder(spark, tmp_path):
    import glob

    from reclaim.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    docs = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(20)], VECTORS)
    va.cluster(docs, dim=2, rounds=1).collect()
    assert not glob.glob(f"{root}/reclaim-vectors/*/*")


def test_query_equals_sql(spark):
    from reclaim.llm.queries import op12_va_clusters

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_TINY}/embeddings.parquet'")
    columns = "vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256"
    theirs = sorted(con.execute(f"SELECT {columns} FROM ({va.sql()})").fetchall(), key=repr)
    assert collected(op12_va_clusters(spark, SF_TINY)) == theirs
