import hashlib

import public_tokenizers
import pytest
from cases import SF_TINY, clashing_docs, empty_docs, odd_docs
from sentencepiece import SentencePieceProcessor

from reclaim.llm import sentencepiece_codec as sc

with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    MODEL = f.read()


def expected(text):
    sp = SentencePieceProcessor(model_proto=MODEL)
    ids = sp.encode(text or "", add_eos=True)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("make", [odd_docs, clashing_docs, lambda spark: spark.read.parquet(f"{SF_TINY}/documents.parquet")])
def test_equals_the_library_on_whole_texts(spark, make):
    docs = make(spark)
    want = sorted(((r.doc_id, *expected(r.text)) for r in docs.collect()), key=repr)
    assert sorted(map(tuple, sc.digests(docs, MODEL).collect()), key=repr) == want


def test_empty_table(spark):
    assert sc.digests(empty_docs(spark), MODEL).collect() == []


def test_heap_and_rows_agree_and_the_cache_may_be_tiny(spark):
    codec = sc.Codec(MODEL, cache_bytes=20_000)
    text = "thinking about wonderful rivers and " * 30 + "zz" * 100 + " " + "é😀" * 20
    sp = SentencePieceProcessor(model_proto=MODEL)
    assert codec.encode_batch([text, text])[1].tolist() == sp.encode(text, add_eos=True)
    words = ["▁thinking", "▁wonderful", "▁▁x", "▁é"]
    import numpy as np

    for w in words:
        assert np.frombuffer(codec.merge_rows([w], 16)[0], np.int32).tolist() == codec.merge(w)


def test_a_wrong_merge_is_noticed(spark):
    codec = sc.Codec(MODEL)
    codec.pair_rank[:] = sc.NEVER
    with pytest.raises(ValueError, match="differently"):
        codec.encode_batch(["thinking"])
