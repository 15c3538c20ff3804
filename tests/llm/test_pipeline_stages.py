import os
import sys

from cases import DOCS, SF_TINY, empty_docs, odd_docs, sentence

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import random

import corpus_pipeline as cp


def walk(spark, docs):
    out = []
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF_TINY)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs)
    return out


def corpus():
    rng = random.Random(9)
    passage = sentence(rng, 80)
    rows = [(i, "\n".join(sentence(rng, 40) for _ in range(3)), "en") for i in range(40)]
    rows += [(100, rows[3][1], "en"), (101, rows[4][1] + " extra", "en")]  # an exact and a near copy
    rows += [(200 + i, sentence(rng, 60) + " " + passage, "en") for i in range(3)]
    rows += [(300, "12345 67890", "en"), (301, None, None)]
    rows += [(400 + i, "\n".join([sentence(rng, 50), f"Page {i} of the same long running notice"]), "en") for i in range(12)]
    return [(*r, "s", 0) for r in rows], passage


def test_decisions_of_every_stage(spark):
    rows, passage = corpus()
    language, lines, near, repeats, packed = walk(spark, spark.createDataFrame(rows, DOCS))
    ids = lambda df: {r.doc_id for r in df.collect()}
    everyone = {r[0] for r in rows}
    assert ids(language) == everyone - {300, 301}
    assert ids(lines) == ids(language)
    notices = [r.doc_id for r in lines.collect() if "running notice" in r.text]
    assert notices == [400]
    assert ids(near) == ids(lines) - {100, 101}
    assert ids(repeats) == ids(near)
    holders = [r.doc_id for r in repeats.collect() if passage in r.text]
    assert holders == [200]
    untouched = {r.doc_id: r.text for r in repeats.collect()}
    assert all(untouched[r[0]] == r[1] for r in rows[:40])
    assert ids(packed) == ids(repeats)
    assert all(r.n_chars == len(r.text) for r in repeats.collect())


def test_run_equals_the_stages(spark, tmp_path):
    rows, _ = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = cp.run(spark, str(tmp_path))
    want = walk(spark, spark.createDataFrame(rows, DOCS))[-1]
    key = lambda df: sorted((r.doc_id, r.piece, r.ids_crc32) for r in df.collect())
    assert key(got) == key(want)


def test_odd_and_empty_documents(spark):
    last = walk(spark, odd_docs(spark))
    kept = {r.doc_id for r in last[0].collect()}
    assert not kept & {0, 10, 20, 30, 60}
    assert last[-1].count() > 0
    for df in walk(spark, empty_docs(spark)):
        assert df.count() == 0


def test_lines_of_fields_are_not_templates(spark):
    """Rows of numbers, texts without blanks and short lines that differ only
    where a template has a field are content; a notice that varies is not."""
    letter = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for i in range(26):
        own = [f"{1990 + i} {i}.5 {i}.1", f"Mean {i}.1 {i}.2 {i}.3 {i}.4", "\u8fd9\u662f" + chr(0x4E00 + i) * 9 + "1" + chr(0x5E00 + i) * 40, f"He went to {letter[i]}town"]
        own.append(f"We saw that 7 8 9 {letter[i]}mere words")
        rows.append((i, "\n".join([*own, f"Page {i} of the same long running notice"]), "en", "s", 0))
    got = {r.doc_id: r.text for r in cp.lines(spark, spark.createDataFrame(rows, DOCS), SF_TINY).collect()}
    assert got[0] == rows[0][1]
    assert all(got[r[0]] == r[1].rpartition("\n")[0] for r in rows[1:])


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    rng = random.Random(2)
    a, b = sentence(rng, 60), sentence(rng, 60)
    rows = [(1, a), (5, a), (5, b), (None, a), (None, a), (None, sentence(rng, 40))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = sorted(((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SF_TINY).collect()), key=repr)
    assert got == sorted([(1, a), (5, b), rows[5]], key=repr)


def test_without_labels_documents_with_letters_stay(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(["some words", "12 34", None, "more"])], DOCS)
    assert {r.doc_id for r in cp.language(spark, docs, SF_TINY).collect()} == {0, 3}


def test_one_label_and_many_labels(spark):
    letters = "abcdefghij"
    for k in (1, 10):
        rows = [(i, " ".join(letters[i % k] * 3 + c for c in random.Random(i).choices("xyz", k=12)), f"l{i % k}", "s", 0) for i in range(400)]
        assert cp.language(spark, spark.createDataFrame(rows, DOCS), SF_TINY).count() == 400


def test_repeated_long_lines_go_with_the_repeats(spark):
    rng = random.Random(8)
    passage, short = sentence(rng, 60), "a short line that stands twice"
    rows = [(i, f"{sentence(rng, 20)}\n{passage}\n{short}", "en", "s", 0) for i in range(3)]
    lines = cp.lines(spark, spark.createDataFrame(rows, DOCS), SF_TINY)
    assert all(passage in r.text for r in lines.collect())
    got = {r.doc_id: r.text for r in cp.repeats(spark, lines, SF_TINY).collect()}
    assert [passage in got[i] for i in range(3)] == [True, False, False]
