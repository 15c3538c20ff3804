import hashlib
import random
import re

import numpy as np
import pytest

from reclaim.llm import fill_in_middle as fim

from cases import DOCS, SF_TINY, by_id, clashing_docs, empty_docs, odd_docs

COLUMNS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def plain_version(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    h = hashlib.sha256(("7:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    k = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = ("".join(units[i:j]) for i, j in ((0, k[0]), (k[0], k[1]), (k[1], n)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def lined(rng):
    return "".join(rng.choice("ab é😀.\n\n<PSM>") for _ in range(rng.randrange(200)))


def test_wavelet_ranks_and_reach():
    rng = np.random.default_rng(3)
    for size in (1, 63, 64, 65, 1000):
        classes = rng.integers(0, 4, size).astype(np.uint8)
        matrix = fim.WaveletMatrix(classes)
        a = rng.integers(0, size + 1, 50)
        b = np.minimum(size, a + rng.integers(0, size + 1, 50))
        for kind in range(4):
            assert matrix.rank(kind, a, b).tolist() == [int((classes[x:y] == kind).sum()) for x, y in zip(a, b)]
        ends = np.flatnonzero(np.isin(classes, (1, 3))) + 1
        if len(ends):
            count = np.arange(1, len(ends) + 1)
            start = np.zeros(len(ends), np.int64)
            assert matrix.reach((1, 3), start, np.full(len(ends), size), count).tolist() == ends.tolist()


@pytest.mark.parametrize("unit", list(fim.UNITS))
@pytest.mark.parametrize("chunk", [7, 64, fim.CHUNK])
def test_cuts_like_a_loop_over_units(unit, chunk):
    rng = random.Random(5)
    texts = ["", "a", "\n", "a\n", "\n\n.", *(lined(rng) for _ in range(60))]
    kinds, table = fim.UNITS[unit], fim.class_table()
    cutter = fim.Cutter(texts, kinds, table, chunk)
    for share in (0.0, 0.3, 0.7, 1.0):
        wanted, places = [], []
        for i, t in enumerate(texts):
            ends = [j + 1 for j, c in enumerate(t) if table[ord(c)] in kinds]
            ends += [len(t)] if t and (not ends or ends[-1] != len(t)) else []
            assert cutter.n[i] == len(ends)
            wanted.append(round(share * len(ends)))
            places.append([0, *ends][wanted[-1]])
        assert cutter.cut(np.array(wanted)).tolist() == places


@pytest.mark.parametrize("chunk", [11, fim.CHUNK])
def test_transform_equals_plain_version(spark, chunk):
    rng = random.Random(1)
    rows = [(i, lined(rng), None, None, None) for i in range(400)] + [(7, "same\nid", None, None, None), (None, "a\nb\nc", None, None, None), (3, "has <P> inside\n", None, None, None), (4, "end <\nS>\nP>", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = by_id(fim.transform(docs, chunk=chunk), *COLUMNS)
    assert got == sorted(((r[0], *plain_version(r[0], r[1])) for r in rows), key=repr)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_restores_the_text(spark):
    for unit in fim.UNITS:
        docs = odd_docs(spark)
        out = fim.transform(docs, unit=unit, spm_rate=30, rate=80).select("doc_id", fim.restored().alias("text"))
        assert by_id(out, "text") == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)


def test_rates(spark):
    docs = odd_docs(spark)
    assert {r.form for r in fim.transform(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(docs, spm_rate=0).collect()} == {"plain", "psm"}


def test_odd_and_clashing_and_empty(spark):
    docs = odd_docs(spark)
    expected = sorted(((r.doc_id, *plain_version(r.doc_id, r.text)) for r in docs.collect()), key=repr)
    assert by_id(fim.transform(docs), *COLUMNS) == expected
    clashing = clashing_docs(spark).withColumn("form", fim.F.lit(3)).withColumn("output", fim.F.lit("x"))
    assert set(by_id(fim.transform(clashing), *COLUMNS)) <= set(expected)
    assert fim.digests(empty_docs(spark)).collect() == []


def test_query_equals_plain_version(spark):
    from reclaim.llm.queries import op13_wavelet_fim

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for r in spark.read.parquet(f"{SF_TINY}/documents.parquet").collect():
        n, form, a, m, out = plain_version(r.doc_id, r.text)
        expected.append((r.doc_id, n, form, a, m, sha(out), sha(r.text or "")))
    got = by_id(op13_wavelet_fim(spark, SF_TINY), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    assert got == sorted(expected, key=repr)
