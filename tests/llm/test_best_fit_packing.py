import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import SF_TINY, clashing_docs, empty_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reclaim.llm import best_fit_packing as bf

with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
    FILE = f.read()


def check(docs, **kw):
    tok = Tokenizer.from_str(FILE.decode())
    rows = bf.packed(docs, FILE, **kw).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [bf.END_ID], "<u4")
        want += [(r.doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(bf.cut(len(ids), bf.LIMIT))]
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == sorted(want, key=repr)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= bf.LIMIT
    return len(places), sum(r.length for r in rows)


@pytest.mark.parametrize("make", [odd_docs, clashing_docs])
def test_odd_texts(spark, make):
    check(make(spark))


def test_real_texts_are_packed_tightly(spark):
    n, tokens = check(spark.read.parquet(f"{SF_TINY}/documents.parquet"))
    assert n <= 1.03 * tokens / bf.LIMIT + 1


def test_shards_are_packed_apart(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    check(docs, shard=20)


def test_strings_of_added_tokens(spark):
    texts = ["hello <|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext| >", "<|ENDOFTEXT|>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(docs)
    assert {r.doc_id: r.ids[:-1] for r in bf.pieces(docs, FILE).collect()}[0] == [31373, 220, 50256, 2124]


def test_one_row_repeated_fills_many_shards(spark):
    for doc in (None, 7):
        docs = spark.createDataFrame([(doc, "one text again and again")], "doc_id long, text string").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000))))
        sequences = [r.sequence_id for r in bf.packed(docs, FILE, shard=100).collect()]
        assert len(sequences) == 2000 and len({s >> 32 for s in sequences}) == 20


def test_long_documents_follow_the_pieces(spark):
    docs = spark.createDataFrame([(i, "word " * 30_000) for i in range(4)], "doc_id long, text string")
    n, tokens = check(docs, shard=20)
    assert len({r.sequence_id >> 32 for r in bf.packed(docs, FILE, shard=20).collect()}) > 3


def test_empty_table(spark):
    assert bf.packed(empty_docs(spark), FILE).collect() == []


def test_cut():
    assert bf.cut(1, 10) == [(0, 1)] and bf.cut(10, 10) == [(0, 10)] and bf.cut(20, 10) == [(0, 10), (10, 10)]
    assert bf.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def greedy(lengths, limit):
    """Longest that fits, without replacements."""
    left, bins = sorted(lengths), 0
    while left:
        gap = limit - left.pop()
        bins += 1
        while True:
            fit = [i for i, n in enumerate(left) if n <= gap]
            if not fit:
                break
            gap -= left.pop(fit[-1])
    return bins


def plain_two_fit(lengths, limit):
    """Best-two-fit by trying every piece and every pair."""
    left, bins = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)), []
    while left:
        held = [left.pop(0)]
        gap = limit - lengths[held[0]]
        while fits := [i for i in left if lengths[i] <= gap]:
            held.append(fits[0])
            left.remove(fits[0])
            gap -= lengths[fits[0]]
        while gap > 0 and len(held) > 1:
            out = min(held, key=lambda i: lengths[i])
            pairs = [(lengths[i] + lengths[j], i, j) for i, j in itertools.combinations(left, 2) if lengths[out] < lengths[i] + lengths[j] <= gap + lengths[out]]
            if not pairs:
                break
            total = max(pairs)[0]
            # Of the tightest pairs the one with the shortest piece.
            _, i, j = min((p for p in pairs if p[0] == total), key=lambda p: min(lengths[p[1]], lengths[p[2]]))
            held = [x for x in held if x != out] + [i, j]
            left = sorted([x for x in left if x not in (i, j)] + [out], key=lambda x: (-lengths[x], x))
            gap += lengths[out] - total
        bins.append(sorted(lengths[i] for i in held))
    return bins


def test_like_the_plain_version():
    rng = random.Random(11)
    for _ in range(60):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 60))]
        sequence, _ = bf.two_fit(lengths, 64, slack=0)
        bins = {}
        for s, n in zip(sequence, lengths):
            bins.setdefault(s, []).append(n)
        assert [sorted(b) for _, b in sorted(bins.items())] == plain_two_fit(lengths, 64)


def test_two_replace_one():
    # 6 + 3 leaves 1 free; 3 gives way to 2 + 2, which fill the gap.
    sequence, offset = bf.two_fit([6, 3, 2, 2], 10, slack=0)
    assert sequence[0] == sequence[2] == sequence[3] == 0 and sequence[1] == 1
    assert sorted(offset[i] for i in (0, 2, 3)) == [0, 6, 8]


def test_no_more_bins_than_greedy():
    rng = random.Random(3)
    for _ in range(30):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 120))]
        sequence, _ = bf.two_fit(lengths, 64, slack=rng.choice([0, 4]))
        used = {}
        for s, n in zip(sequence, lengths):
            used[s] = used.get(s, 0) + n
        assert max(used.values()) <= 64
        assert len(used) <= greedy(lengths, 64) + 1


def test_a_file_with_another_order_is_refused():
    import json

    spec = json.loads(FILE)
    spec["model"]["merges"][0], spec["model"]["merges"][1] = spec["model"]["merges"][1], spec["model"]["merges"][0]
    with pytest.raises(ValueError, match="order"):
        bf.encoder(json.dumps(spec).encode())
