import hashlib
import re

import numpy as np
import pytest
from cases import SF_TINY, by_id, clashing_docs, empty_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from reclaim.llm import suffix_array as sa


def brute(rows, length=100):
    """(n_bytes, n_removed, n_spans, sha256) of (doc_id, text) rows."""
    seen, out = set(), []
    for doc, text in sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r)):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out.append((doc, text, (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())))
    return {(d, t): x for d, t, x in out}


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    expected = sorted(((d, *want[(d, t or "")]) for d, t in rows), key=repr)
    assert by_id(sa.digests(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


@pytest.mark.parametrize("make", [odd_docs, clashing_docs])
def test_equals_brute_force_on_odd_texts(spark, make):
    check(make(spark))


def test_equals_brute_force_across_many_shards_and_parts(spark, monkeypatch):
    monkeypatch.setattr(sa, "MB", 1 << 13)  # shards of 32 kB
    monkeypatch.setattr(sa, "PART", 3000)  # long texts are cut
    check(spark.read.parquet(f"{SF_TINY}/documents.parquet").select("doc_id", "text"))


def test_repetitive_texts(spark, monkeypatch):
    monkeypatch.setattr(sa, "MB", 1 << 8)
    rows = [(1, "ab" * 400), (2, "ab" * 60), (3, "b" + "ab" * 100 + "c"), (4, "\x00" * 350), (5, "\x00" * 120 + "x"), (6, "é" * 90)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_empty_table(spark):
    assert sa.digests(empty_docs(spark)).collect() == []


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 2), (40, 2), (500, 2), (500, 3), (300, 1)):
        raw = rng.integers(0, letters, n).astype(np.uint8)
        b = raw.tobytes()
        order = sa.suffix_array(raw)
        assert order.tolist() == sorted(range(n), key=lambda i: b[i:])
        lcp = sa.common_prefixes(raw, order, 100)

        def common(i, j):
            k = 0
            while k < 100 and i + k < n and j + k < n and b[i + k] == b[j + k]:
                k += 1
            return k

        assert lcp.tolist() == [0] + [common(i, j) for i, j in zip(order[:-1].tolist(), order[1:].tolist())]


def test_merge_of_sorted_runs():
    key = np.array([5, 7, 9, 7, 5, 11, 7], np.uint64)
    owner = np.array([3, 1, 4, 0, 2, 6, 5])
    runs = [np.array([0, 1, 2]), np.array([3]), np.array([4, 5]), np.array([6])]
    beaten = sa.merge_runs(runs, key, owner, lambda i, j: np.ones(len(i), bool))
    assert beaten.tolist() == [True, True, False, False, False, False, True]


def test_cut_texts_keeps_whole_characters_and_columns(spark):
    docs = clashing_docs(spark)
    out = sa.cut_texts(docs)
    assert out.columns == [c for c in docs.columns if c != "starts"] + ["n_removed"]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text is None and rows[80].text == "" and rows[70].text == odd_rows()[7][1]
    accents = spark.createDataFrame([(1, "x" + "é" * 80), (2, "é" * 80)], "doc_id long, text string")
    cut = {r.doc_id: r for r in sa.cut_texts(accents).collect()}
    assert set(cut[2].text) <= {"é"} and cut[2].n_removed % 2 == 0
    assert sa.cut_texts(accents.where(F.lit(False))).count() == 0
