import hashlib

import numpy as np
import pytest
from cases import by_id, clashing_docs, empty_docs, odd_docs

from reclaim.llm import order_minhash as om


def slow_fingerprint(text, k=om.K, hashes=om.HASHES, take=om.TUPLE):
    """Occurrences counted in a dictionary, tuples picked by sorting."""
    kmers = om.kmers(om.codes(text), k)
    seen, numbered = {}, []
    for h in kmers.tolist():
        n = seen[h] = seen.get(h, -1) + 1
        numbered.append(h + int(om.GOLD) + n * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    numbered = om.mix(np.array(numbered, np.uint64))
    out = []
    for j in range(hashes):
        x = (numbered * om.ODD[j]).tolist()
        chosen = sorted(sorted(range(len(x)), key=x.__getitem__)[:take])
        h = np.full(1, len(chosen), np.uint64)
        for i in chosen:
            h = om.mix(h * np.uint64(0x100000001B3) + numbered[i : i + 1])
        out.append(int(h[0]) >> 32)
    return np.array(out, np.uint32)


def brute(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r))
    out = []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        a, b, c = (slow_fingerprint(t) for t in (text, changed, following))
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.astype(">u4").tobytes().hex(), b.astype(">u4").tobytes().hex(), float((a == b).mean()), float((a == c).mean())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("make", [odd_docs, clashing_docs])
@pytest.mark.parametrize("unit", [1 << 20, 1 << 10])  # one range, many ranges
def test_equals_a_plain_version(spark, make, unit, monkeypatch):
    from reclaim.llm import common

    monkeypatch.setattr(common, "MB", unit)
    docs = make(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = om.edited(docs)
    assert by_id(got, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == brute(rows)


def test_empty_and_single(spark):
    assert om.edited(empty_docs(spark)).collect() == []
    one = om.edited(spark.createDataFrame([(5, "some words to read again and again")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and 0 <= one.near_edited <= 1


def test_order_matters_and_repeats_count():
    rng = np.random.default_rng(0)
    a = "".join(rng.choice(list("abcdefghij"), 600))
    swapped = a[300:] + a[:300]
    small_edit = a[:290] + "XYZ" + a[293:]
    f = lambda t: om.fingerprint(t, hashes=60)
    assert om.likeness(f(a), f(a)) == 1.0
    assert om.likeness(f(a), f(small_edit)) > om.likeness(f(a), f(swapped))
    assert om.likeness(f("ab" * 50), f("ab" * 100)) < 1.0
    assert om.likeness(f(""), f("")) == 1.0 and om.likeness(f(""), f("abc")) == 0.0


def test_columns_of_long_texts():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh"), 3 * om.COLUMNS + 17))
    assert np.array_equal(om.fingerprint(text), slow_fingerprint(text))
