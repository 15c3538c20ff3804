"""Shared inputs of the operator tests: documents with nulls, empty, very
long, equal and near-equal texts, and columns whose names clash with results."""

import random

SF_TINY = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCS + ", kept boolean, ids array<int>, shard int, component_id long, n_lines long, starts string, h long"


def sentence(rng, n=12):
    words = "river stone garden window paper silver morning engine letter market bridge forest candle mirror".split()
    return " ".join(rng.choice(words) + rng.choice(["", "s", "ed"]) for _ in range(n))


def odd_rows(seed=0):
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    base = [sentence(rng, 80) + "." for _ in range(6)]
    texts = [None, "", " ", "\n\n", "a", "É", "12 34", base[0], base[0], base[1], base[1].replace("river", "rivers", 1),
             f"{base[2]} {passage}", f"{passage}\n{base[3]}", f"{passage} {passage}", "x" * 300, "wörter ñandú 日本語 😀 " * 40,
             " ".join(sentence(rng, 30) for _ in range(300)), "<|endoftext|> <s> ▁", "tab\tand\x0bfeed\x0c end\r\n", "\x00zero\x00"]
    return [(i * 10, t, None if i % 7 == 3 else ["en", "fr"][i % 2], "s", 0) for i, t in enumerate(texts)]


def odd_docs(spark):
    """The odd rows, one of them twice, and one without an id."""
    rows = odd_rows()
    return spark.createDataFrame(rows + [rows[7], (None, "no id at all, only words here to read", "en", None, None)], DOCS)


def clashing_docs(spark):
    return spark.createDataFrame([(*r, True, [1], 5, 99, 7, "s", 3) for r in odd_rows()], CLASHING)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, *cols):
    return sorted((tuple(r[c] for c in ("doc_id", *cols)) for r in df.collect()), key=repr)
