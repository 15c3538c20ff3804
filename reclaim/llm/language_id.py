"""Operator 4: language identification.

Sparse multinomial logistic regression on TF-IDF character n-grams.  Texts are
lower-cased, every run of non-letters is one space; 1- to 3-grams are hashed to
``BUCKETS``; a document's vector is (1 + ln tf) * idf, scaled to length 1.

1. Document frequencies: one pass over every learning document; a partition
   sends one count per bucket.
2. Training: follow-the-regularised-leader (proximal) with elastic-net
   penalties on a bounded sample, at most ``SAMPLE`` documents of each label
   (about those with the smallest hash of doc_id and text), in one task of
   bounded size, however often a row is repeated.
3. Calibration: a temperature fitted on a fifth of the sample that training
   left out.
4. Prediction: every whole text, streamed; the model (BUCKETS x labels) is the
   only thing sent to the tasks.

Learning documents have a label, a text and an id whose crc32 mod 3 is not 1.

Cases: null text and text without letters give ``und`` and score 0; without
learning documents all get ``und``; with one label that label has score 1;
ties go to the label first in order; a null doc_id is never held out nor
learned from; texts of any length are read whole; repeated rows are predicted
alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_worker, tidy

BUCKETS = 1 << 14
SAMPLE = 800  # learning documents of a label, at most
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
DOCS = 64  # documents counted together
CHARS = 1 << 18  # characters of one document counted at a time
UNKNOWN = "und"


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or a space for all else."""
    out = np.full(sys.maxunicode + 1, 32, np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(ch := chr(c))[0] == "L":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Grams:
    """Hashed n-gram counts of texts."""

    def __init__(self, buckets: int = BUCKETS):
        self.letters, self.buckets = letter_table(), buckets
        self.shift = np.uint32(32 - (buckets.bit_length() - 1))

    def keys(self, text: str) -> Iterator[np.ndarray]:
        """Buckets of all n-grams; long texts come in pieces that share the
        two characters at their border."""
        code = self.letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = code == 32
        code = np.concatenate([[np.uint32(32)], code[~(blank & np.concatenate([[True], blank[:-1]]))], [np.uint32(32)]]).astype(np.uint32)
        if not (code != 32).any():
            return
        for at in range(0, len(code), CHARS):
            a = code[at : at + CHARS + 2]
            one = a[:CHARS]
            two = (a[:-1] * np.uint32(0x01000193)) ^ a[1:]
            three = (two[:-1] * np.uint32(0x01000193)) ^ a[2:]
            for gram, salt in ((one[one != 32], 1), (two[:CHARS], 2), (three[:CHARS], 3)):
                mixed = (gram + np.uint32(salt * 0x3C6EF372)) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
                yield (mixed * np.uint32(0x85EBCA77)) >> self.shift

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, bucket, count), sparse, documents in order."""
        total = np.zeros(len(texts) * self.buckets, np.int32)
        for i, text in enumerate(texts):
            for key in self.keys(text):
                total[i * self.buckets : (i + 1) * self.buckets] += np.bincount(key, minlength=self.buckets).astype(np.int32)
        cell = np.flatnonzero(total)
        return cell // self.buckets, cell % self.buckets, total[cell]


def weigh(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """TF-IDF weights, each document's scaled to length 1."""
    value = (1 + np.log(count)) * idf[bucket]
    length = np.sqrt(np.bincount(doc, value * value, minlength=n))
    return value / np.maximum(length, 1e-12)[doc]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, classes: int) -> np.ndarray:
    """FTRL-proximal weights (buckets + 1 intercept, classes) of examples
    (bucket, value, label)."""
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))

    def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    target = np.eye(classes)
    for _ in range(EPOCHS):
        for bucket, value, label in rows:
            at = np.append(bucket, buckets)
            x = np.append(value, 1.0)
            z0, n0 = z[at], n[at]
            w = leader(z0, n0)
            g = x[:, None] * (softmax(x @ w) - target[label])[None, :]
            sigma = (np.sqrt(n0 + g * g) - np.sqrt(n0)) / ALPHA
            z[at] = z0 + g - sigma * w
            n[at] = n0 + g * g
    return leader(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden section over its logarithm.
    Targets are smoothed as by one more example of every label, so a sample
    without errors does not push all probabilities to 1."""
    n, classes = logits.shape
    target = np.full(logits.shape, 1.0 / (n + classes))
    target[np.arange(n), labels] = (n + 1.0) / (n + classes)

    def loss(t: float) -> float:
        x = logits / np.exp(t)
        x = x - x.max(1, keepdims=True)
        return float((target * (np.log(np.exp(x).sum(1, keepdims=True)) - x)).sum())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(learn: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all of ``learn``, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, df, n = in_worker(("grams", buckets), lambda: Grams(buckets)), np.zeros(buckets, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                texts = batch.column(0).slice(at, DOCS).to_pylist()
                df += np.bincount(grams.counts(texts)[1], minlength=buckets)
                n += len(texts)
        if n:
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(df[some], n), pa.int64())], ["bucket", "n"])

    rows = learn.select("text").mapInArrow(tidy(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most buckets + 1 rows
    out = np.zeros(buckets, np.int64)
    n = 0
    for b, c in rows:
        if b < 0:
            n = c
        else:
            out[b] = c
    return out, n


class Model:
    """Labels, idf, weights and temperature."""

    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.labels, self.idf, self.weights, self.heat = labels, idf, weights, heat

    def logits(self, doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        value = weigh(doc, bucket, count, self.idf, n)
        out = [np.bincount(doc, value * self.weights[bucket, c], minlength=n) for c in range(len(self.labels))]
        return np.stack(out, 1) + self.weights[-1]

    def predict(self, grams: Grams, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Label, calibrated probability and whether it has a letter, of each
        text."""
        doc, bucket, count = grams.counts(texts)
        empty = np.bincount(doc, minlength=len(texts)) == 0
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~empty
        p = softmax(self.logits(doc, bucket, count, len(texts)) / self.heat)
        best = p.argmax(1)
        score = np.where(empty, 0.0, p[np.arange(len(texts)), best])
        return [UNKNOWN if e else self.labels[b] for e, b in zip(empty, best)], score, ~empty


def train(docs: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> Model:
    """Fit and calibrate on the learning documents among ``docs``."""
    learn = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")
    )
    df, n = document_frequencies(learn, buckets)
    if not n:
        return Model([], np.zeros(buckets), np.zeros((buckets + 1, 0)), 1.0)
    idf = np.log((1 + n) / (1 + df)) + 1
    # A hash threshold of each label leaves somewhat more than the sample, but
    # no less than the rows of the smallest hash; equal rows have one hash, so a
    # window (cut on the map side) bounds what they bring.
    mark = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    most = int(sample + 8 * sample**0.5)
    sizes = learn.groupBy("lang").agg(F.count("*").alias("n"), F.min(mark).alias("low")).collect()  # a row per label
    cut = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, max(r.low + 1, min(1 << 30, int((1 << 30) * (sample + 4 * sample**0.5) / r.n) + 1)))])
    rows = learn.withColumn("mark", mark).where(F.col("mark") < F.element_at(cut, F.col("lang")))
    place = F.row_number().over(W.partitionBy("lang").orderBy("mark", "doc_id", "text"))
    rows = rows.withColumn("place", place).where(F.col("place") <= most).drop("place")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = in_worker(("grams", buckets), lambda: Grams(buckets))
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                doc, bucket, count = grams.counts(part.column(1).to_pylist())
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                lists = lambda x: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), lists(bucket), lists(count)], ["doc_id", "lang", "mark", "bucket", "count"])

    def learn_all(table: pa.Table) -> pa.Table:
        table = table.sort_by([("mark", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        langs = table.column("lang").to_pylist()
        labels = sorted(set(langs))
        bucket, count = (table.column(c).chunk(0) for c in ("bucket", "count"))
        at, bucket, count = bucket.offsets.to_numpy(), bucket.values.to_numpy(), count.values.to_numpy()
        examples, taken = [], dict.fromkeys(labels, 0)
        for i, lang in enumerate(langs):
            b, c = bucket[at[i] : at[i + 1]], count[at[i] : at[i + 1]]
            if len(b) and taken[lang] < sample:
                taken[lang] += 1
                examples.append((b, weigh(np.zeros(len(b), np.int64), b, c, idf, 1), labels.index(lang)))
        order = np.random.default_rng(0).permutation(len(examples))
        kept = [examples[i] for i in order if i % 5] or examples
        left = [examples[i] for i in order if i % 5 == 0]
        weights = fit(kept, buckets, len(labels))
        heat = 1.0
        if left and len(labels) > 1:
            logits = np.stack([v @ weights[b] + weights[-1] for b, v, _ in left])
            heat = temperature(logits, np.array([c for _, _, c in left]))
        return pa.table({"labels": pa.array([labels], pa.list_(pa.string())), "weights": [weights.astype("<f8").tobytes()], "heat": [heat]})

    got = (
        rows.mapInArrow(tidy(features), "doc_id long, lang string, mark long, bucket array<int>, count array<int>")
        .withColumn("all", F.lit(0))
        .groupBy("all")
        .applyInArrow(learn_all, "labels array<string>, weights binary, heat double")
        .first()
    )
    if got is None:
        return Model([], idf, np.zeros((buckets + 1, 0)), 1.0)
    return Model(list(got.labels), idf, np.frombuffer(got.weights, "<f8").reshape(buckets + 1, -1), got.heat)


def predict(docs: DataFrame, model: Model, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = in_worker(("grams", buckets), lambda: Grams(buckets))
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                label, score, _ = model.predict(grams, [t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(label, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score: train on ``docs`` and predict them."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return predict(base, train(base, buckets, sample), buckets).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


ADDED = {"lang_pred": T.StringType(), "lang_score": T.DoubleType(), "lang_letters": T.BooleanType(), "lang_labels": T.IntegerType()}


def scored(docs: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with lang_pred, lang_score, lang_letters (whether the text has
    a letter) and lang_labels (labels that were learned); clashing columns are
    replaced.  Rows keep their other columns, without a join."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(base, buckets, sample)
    names = [c for c in docs.columns if c not in ADDED]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(c, kind) for c, kind in ADDED.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = in_worker(("grams", buckets), lambda: Grams(buckets))
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                label, score, letters = model.predict(grams, [t or "" for t in part.column(names.index("text")).to_pylist()])
                added = [pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(letters), pa.array([len(model.labels)] * len(label), pa.int32())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*names, *ADDED])

    return docs.select(*names).mapInArrow(tidy(run), schema)
