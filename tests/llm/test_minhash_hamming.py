import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import SF_TINY, by_id, clashing_docs, empty_docs, odd_docs

from reclaim.llm import minhash_hamming as mh
from reclaim.llm.shingles import shingle_sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) or same:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert by_id(mh.components(docs), "n_shingles", "component_id", "kept") == brute(rows)


@pytest.mark.parametrize("make", [odd_docs, clashing_docs])
def test_odd_texts(spark, make):
    check(make(spark))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_around_the_threshold_and_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK", 8)  # clusters are compared in blocks
    monkeypatch.setattr(mh, "COLUMNS", 100)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(12):
        words = [f"g{g}x{i}" for i in range(90)]
        rows += [edited(rng, words, n) for n in (0, 1, 2, 2, 3, 3, 4)]
        rows += [" ".join(passage) + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(4)]
    rng.shuffle(rows)
    check(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_sample_of_real_texts(spark):
    check(spark.read.parquet(f"{SF_TINY}/documents.parquet").select("doc_id", "text"))


def test_empty_table(spark):
    assert mh.components(empty_docs(spark)).collect() == []


def test_every_pair_within_the_distance_shares_a_list(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 16, (40, mh.VALUES)).astype("<u2")
    b = a.copy()
    for i, row in enumerate(b):
        at = rng.permutation(mh.VALUES)[: mh.DISTANCE if i % 2 else rng.integers(0, mh.DISTANCE)]
        row[at] ^= 1 + rng.integers(0, 1000, len(at)).astype("<u2")
    rows = [(i, x.tobytes()) for i, x in enumerate(a)] + [(100 + i, x.tobytes()) for i, x in enumerate(b)]
    lists = {}
    for r in mh.listed(spark.createDataFrame(rows, "id long, sig binary")).collect():
        lists.setdefault(r.id, Counter())[r.key] += 1
    assert all(len(x) == 4 * mh.CHUNKS for x in lists.values())
    assert all(lists[i].keys() & lists[100 + i].keys() for i in range(40))


def test_shingles_do_not_depend_on_blocks(monkeypatch):
    texts = [("Some WORDS, and more " * 50).encode(), b"", b"one", b" \t ", "ä b c d e f".encode(), b"x" * 5000 + b" y z"]
    whole = shingle_sets(texts)
    assert [len(s) for s in whole] == [len(shingles(t.decode())) for t in texts]
    from reclaim.llm import shingles as module

    monkeypatch.setattr(module, "BLOCK", 37)
    assert all(np.array_equal(x, y) for x, y in zip(whole, shingle_sets(texts)))


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (200, 100)]
    got = {r.id: r.component for r in mh.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (100, 101, 102, 200)} == {100}
