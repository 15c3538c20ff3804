import random

import numpy as np
from cases import clashing_docs, empty_docs, odd_docs
from pyspark.sql import functions as F

from reclaim.llm import language_id as li

WORDS = {"aa": "the river runs under stone", "bb": "der fluss unter dem stein läuft", "cc": "le fleuve coule sous la pierre"}


def labelled(spark, n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(12)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_scores(spark):
    docs = labelled(spark)
    out = li.identify(docs).join(docs, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert 40 < len(held) < 120
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0.5 < r.score < 1 for r in out)


def test_labels_of_held_out_documents_are_not_used(spark):
    docs = labelled(spark)
    wrong = docs.withColumn("lang", F.when(li.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(li.identify(docs)) == key(li.identify(wrong))


def test_held_out_is_the_crc_rule(spark):
    import zlib

    df = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", li.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in df.collect())


def test_odd_texts(spark):
    for docs in (odd_docs(spark), clashing_docs(spark)):
        out = li.identify(docs).collect()
        assert len(out) == docs.count()
        rows = {r.doc_id: r for r in out}
        for doc in (0, 10, 20, 30, 60):  # null, empty, blank, no letter
            assert (rows[doc].lang_pred, rows[doc].score) == ("und", 0.0)
        assert rows[50].lang_pred in ("en", "fr") and 0 < rows[50].score <= 1


def test_empty_and_unlabelled_tables(spark):
    assert li.identify(empty_docs(spark)).collect() == []
    out = li.identify(labelled(spark, 9).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    one = li.identify(labelled(spark, 60).withColumn("lang", F.lit("aa"))).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("aa", 1.0)}


def test_long_texts_count_every_gram_once():
    grams = li.Grams(1 << 10)
    text = "ab cde " * 3000
    whole = grams.counts([text])[2].sum()
    old, li.CHARS = li.CHARS, 777
    try:
        assert grams.counts([text])[2].sum() == whole
    finally:
        li.CHARS = old


def test_scored_keeps_columns(spark):
    docs = labelled(spark, 60).withColumn("lang_score", F.lit("old"))
    out = li.scored(docs)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score", "lang_letters", "lang_labels"] and out.count() == 60


def test_repeated_learning_rows(spark):
    for doc in (0, 1, 7):
        one = spark.createDataFrame([(doc, "the river runs under stone", "aa")], "doc_id long, text string, lang string")
        docs = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000))))
        learned = not li.identify(one).first().held_out
        assert {(r.lang_pred, r.score) for r in li.identify(docs).distinct().collect()} == {("aa", 1.0) if learned else ("und", 0.0)}
        other = docs.union(labelled(spark, 60).withColumn("n", F.lit(0)))
        assert {r.lang_pred for r in li.identify(other).collect()} <= set(WORDS)


def test_ftrl_like_a_loop_over_coordinates():
    """Each coordinate's update as the algorithm states it, in plain floats."""
    import math

    rng = random.Random(4)
    buckets, classes = 10, 3
    rows = [(np.array(sorted(rng.sample(range(9), 4))), np.array([rng.random() for _ in range(4)]), rng.randrange(classes)) for _ in range(25)]
    rows.append((np.array([9]), np.array([0.004]), 0))  # too little for a weight
    z, n = ([[0.0] * classes for _ in range(buckets + 1)] for _ in range(2))

    def weight(i, c):
        if abs(z[i][c]) <= li.L1:
            return 0.0
        return -(z[i][c] - math.copysign(li.L1, z[i][c])) / ((li.BETA + math.sqrt(n[i][c])) / li.ALPHA + li.L2)

    for _ in range(li.EPOCHS):
        for bucket, value, label in rows:
            x = [*zip(bucket.tolist(), value.tolist()), (buckets, 1.0)]
            w = {(i, c): weight(i, c) for i, _ in x for c in range(classes)}
            e = [math.exp(sum(v * w[i, c] for i, v in x)) for c in range(classes)]
            for c in range(classes):
                error = e[c] / sum(e) - (c == label)
                for i, v in x:
                    g = error * v
                    sigma = (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / li.ALPHA
                    z[i][c] += g - sigma * w[i, c]
                    n[i][c] += g * g
    want = np.array([[weight(i, c) for c in range(classes)] for i in range(buckets + 1)])
    assert np.allclose(li.fit(rows, buckets, classes), want, atol=1e-12) and (want == 0).any() and (want != 0).any()
