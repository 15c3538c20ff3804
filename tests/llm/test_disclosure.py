import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from cases import DOCS, SF_TINY, by_id, clashing_docs, empty_docs, odd_docs
from reclaim.llm import disclosure as di

# The patterns as the contract states them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        double = lambda d: d * 2 - 9 if d > 4 else d * 2
        return 12 <= len(digits) <= 19 and sum(double(int(d)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_base(text):
    found = [(m.start(), list(PATTERNS).index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if holds(k, m[0])]
    return sorted(found)


def plain_disclosing(texts, alpha=di.ALPHA, support=di.SUPPORT, size=32):
    """Counts over a list of all segments."""
    rows = []  # features, entities, words
    for text in texts:
        spans, offset = plain_base(text), 0
        for line in text.split("\n"):
            words = [(m.start() + offset, m.end() + offset, m[0].lower()) for m in re.finditer(r"\w+", line)]
            for i in range(0, len(words), size):
                part = words[i : i + size]
                before = words[i - 1][1] if i else offset
                terms = {w for x, y, w in part if len(w) > 2 and not any(a < y and x < b for a, _, b in spans)}
                inside = {(k, text[a:b]) for a, k, b in spans if before <= a < part[-1][1]}
                rows.append((terms | {w[:3] + "*" for w in terms if len(w) > 3}, inside, " ".join(w for _, _, w in part)))
            offset += len(line) + 1
    n, n_t, n_c = len(rows), Counter(), Counter()
    n_tc, where = Counter(), defaultdict(set)
    for terms, inside, words in rows:
        n_t.update(terms)
        n_c.update(inside)
        for c in inside:
            for t in terms:
                n_tc[t, c] += 1
                where[t, c].add(words)
    strong = set()
    for (t, c), k in n_tc.items():
        if len(where[t, c]) >= support and n_c[c] < n and math.log2(k * n / (n_t[t] * n_c[c])) / math.log2(n / n_c[c]) >= alpha:
            strong.add(t)
    return {t: t[:3] + "*" if len(t) > 3 and t[:3] + "*" not in strong else "" for t in strong if not t.endswith("*")}


def plain_version(text, terms):
    base = plain_base(text)
    more = [(m.start(), 4, m.end()) for m in re.finditer(r"\w+", text) if m[0].lower() in terms and not any(a < m.end() and m.start() < b for a, _, b in base)]
    spans = sorted(base + more)
    out, done = "", 0
    for a, k, b in spans:
        if a >= done:
            out += text[done:a] + (terms[text[a:b].lower()] if k == 4 else f"<{list(PATTERNS)[k].upper()}>")
        done = max(done, b)
    return [(["email", "ip", "card", "phone", "term"][k], a, b) for a, k, b in spans], out + text[done:]


def told(rng, who, mail):
    words = "river stone garden window paper silver morning engine letter market bridge forest candle mirror".split()
    return " ".join(rng.choices(words, k=6)) + f" {who} wrote to {mail} about " + " ".join(rng.choices(words, k=5))


def corpus():
    rng = random.Random(2)
    texts = [told(rng, "Zebediah", "zeb.q@mail.example.com") for _ in range(6)]  # one name for one address
    texts += [told(rng, "Zeb", "zeb.q@mail.example.com") for _ in range(4)]
    texts += [told(rng, "maria", f"m{i}@mail.example.com") for i in range(40)]  # a name for many
    texts += ["quokka at 10.20.30.40 today"] * 5  # copies of one segment are one
    texts += [f"number {i} kiosk {w} 10.77.0.1" for i, w in enumerate("abc def ghi jkl".split())]
    texts += ["The zebediah letter\nnothing else", *(f"Zebra and zebu in garden {i}" for i in range(15)), "kiosk kiosk"]
    texts += [" ".join(rng.choices("river stone garden window paper kind kiln".split(), k=40)) for _ in range(60)]
    return texts


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS).repartition(3)


def test_base_spans_like_the_patterns():
    rng = random.Random(7)
    for letters in ("ab.-@@ ", "0123.  ", "0123456789 -", "+0123456789 ().-", "a0.@+- ()123456789é٣"):
        for _ in range(1500):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
            assert di.base_spans(text) == plain_base(text), text
    text = "pay 4111 1111 1111 1111, x@y.zz@w.vv, 1.2.3.4.5.6.7.8 999.1.1.1 +1 (386) 555-3733 a@b"
    assert di.base_spans(text) == plain_base(text)


def test_long_texts_take_linear_time():
    for text in ("x" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "1 " * 200_000, "+1" + "(" * 400_000, "a@" * 200_000, "+" * 400_000):
        assert all(kind != 0 for _, kind, _ in di.base_spans(text))


def test_disclosing_terms(spark):
    texts = corpus()
    found = {r.term: r.replacement for r in di.disclosing(frame(spark, texts)).collect()}
    assert found == plain_disclosing(texts)
    assert "zebediah" in found and "kiosk" in found  # each stands for one entity
    assert not {"maria", "quokka", "river", "wrote"} & set(found)  # many entities, one segment, any text
    assert {"*" in r for r in found.values()} == {True, False}  # some generalised, some removed


@pytest.mark.parametrize("closure", [0, di.CLOSURE])
def test_sanitise_equals_plain_version(spark, closure):
    texts = corpus()
    terms = plain_disclosing(texts)
    got = di.sanitise(frame(spark, texts), closure=closure).collect()
    got = {r.doc_id: ([tuple(s) for s in r.spans], r.sanitised) for r in got}
    assert got == {i: plain_version(t, terms) for i, t in enumerate(texts)}
    assert "zebediah" not in " ".join(t for _, t in got.values()).lower() and "@" not in " ".join(t for _, t in got.values())


def test_a_hot_entity_and_one_long_line(spark):
    rng = random.Random(1)
    texts = [told(rng, "otto", "hot@mail.example.com") for _ in range(300)] + ["word " * 30_000 + "hot@mail.example.com " * 50] + [f"plain text {i}" for i in range(400)]
    found = {r.term: r.replacement for r in di.disclosing(frame(spark, texts)).collect()}
    assert found == plain_disclosing(texts) and "otto" in found


def test_odd_clashing_and_empty(spark):
    rows = odd_docs(spark)
    expected = sorted(((r.doc_id, [], r.text or "") for r in rows.collect()), key=repr)
    assert by_id(di.sanitise(rows), "spans", "sanitised") == expected
    clashing = clashing_docs(spark).withColumn("kind", di.F.lit("x")).withColumn("term", di.F.lit("x")).withColumn("spans", di.F.lit(1))
    assert len(by_id(di.sanitise(clashing), "spans", "sanitised")) == clashing.count()
    assert di.digests(empty_docs(spark)).collect() == []


def test_query_equals_plain_version(spark):
    from reclaim.llm.queries import op11_disclosure

    rows = spark.read.parquet(f"{SF_TINY}/documents.parquet").collect()
    terms = plain_disclosing([r.text or "" for r in rows])
    expected = []
    for r in rows:
        spans, _ = plain_version(r.text or "", terms)
        n = Counter(k for k, _, _ in spans)
        join = lambda s: ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        expected.append((r.doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(join([s for s in spans if s[0] != "term"]).encode()).hexdigest(), join(spans)))
    got = by_id(op11_disclosure(spark, SF_TINY), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    assert got == sorted(expected, key=repr)
