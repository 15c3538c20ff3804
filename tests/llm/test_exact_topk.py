import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reclaim.llm import exact_topk as tk


def brute(rows, k):
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints.setdefault((i, tuple(math.floor(64 * float(np.float32(x))) for x in v)), None)
    out = []
    for q, a in ints:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=20, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, cb int").select("*")
    return sorted(tuple(r) for r in tk.search(df, F.col("vec_id") % 20 == 0, k, **kw).collect())


@pytest.mark.parametrize("block,queries", [(16384, 512), (37, 3)])
def test_equals_brute_force_with_ties_and_odd_vectors(spark, block, queries):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(220)]
    rows += [(300 + i, rows[5][1]) for i in range(30)]  # ties by the score
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")] * 8), (460, [float("inf")] * 8), (None, rows[0][1])]
    rows += [(480, [0.0] * 8), (500, [0.5, 0.25]), (40, rows[40][1]), (520, [])]
    got = run(spark, [(*r, "x", 1) for r in rows], block=block, queries=queries)
    assert got == brute(rows, 20)


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0], "x", 1), (1, [1.0, 0.0], "x", 1)]
    assert run(spark, rows) == [(0, 1, 1, 64 * 64)]
    assert run(spark, rows[:1]) == []
    assert tk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, 20).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, -3e6], "x", 1), (1, [2e6, 1.5e6], "x", 1), (2, [-2e6, 7.25e6], "x", 1)]
    assert run(spark, rows) == brute([r[:2] for r in rows], 20)


def test_the_bound_stops_before_the_end():
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 1, (4000, 2))
    vectors[:50] *= 40
    order = np.argsort(-vectors, axis=0, kind="stable").T
    values = np.take_along_axis(vectors.T, order, 1)
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            reads.append(len(key) if isinstance(key, np.ndarray) and key.ndim == 1 and key.dtype != bool else 0)
            return np.asarray(super().__getitem__(key))

    ids, best = tk.threshold_top(order, values, vectors.view(Counted), np.arange(4000), np.array([1.0, 1.0]), -1, 5)
    assert sum(reads) < 2000
    assert ids.tolist() == np.argsort(-(vectors @ np.array([1.0, 1.0])), kind="stable")[:5].tolist()
