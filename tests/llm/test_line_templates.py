import duckdb
import pandas as pd
import pytest
from cases import SF_TINY, by_id, clashing_docs, empty_docs, odd_docs
from pyspark.sql import functions as F

from reclaim.llm import line_templates as lt


def by_sql(rows):
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.execute("create table documents as select cast(doc_id as bigint) as doc_id, cast(text as varchar) as text from frame")
    return sorted(con.execute(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({lt.SQL})").fetchall(), key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").distinct().collect()]
    got = by_id(lt.digests(docs.dropDuplicates(["doc_id", "text"])), "n_lines", "n_dropped", "kept_sha256")
    assert got == by_sql(rows)
    return {r[0]: r[2] for r in got}


def logs(n=30):
    """Documents with a login line (numbers and names vary), one fixed line,
    and prose of their own."""
    rows = []
    for i in range(n):
        own = f"Only document w{i}a speaks of this matter in w{i}b and w{i}c words"
        login = f"login of user u{'abcdefghijklmnopqrstuvwxyz'[i % 26]} came from host 10.0.0.{i} at time {i}:00 without any further remark"
        fixed = "All   rights\treserved by the owners"
        rows.append((i, "\n".join([own.replace(str(i), "x" * (i + 1)), login, fixed, ""])))
    return rows


def test_templates_with_variable_fields(spark):
    dropped = check(spark.createDataFrame(logs(), "doc_id long, text string"))
    assert dropped[0] == 0 and all(dropped[i] == 2 for i in range(1, 30))


def test_below_the_threshold_nothing_goes(spark):
    dropped = check(spark.createDataFrame(logs(lt.MIN_DOCS - 1), "doc_id long, text string"))
    assert not any(dropped.values())


def test_fields_alone_make_no_template(spark):
    rows = [(i, f"{1990 + i} {i}.5 {i}\nheader {i}\n\u8fd9\u662f{chr(0x4E00 + i) * 30}1{chr(0x5E00 + i) * 40}") for i in range(12)]
    assert not any(check(spark.createDataFrame(rows, "doc_id long, text string")).values())


def test_long_lines_recur_from_two_documents_on(spark):
    long = "word of a long line " * 12
    rows = [(i, f"{long}\n{long} {i}\n  {long}") for i in range(3)] + [(9, "a\n" + long[:100]), (10, long[:100])]
    assert check(spark.createDataFrame(rows, "doc_id long, text string")) == {0: 1, 1: 2, 2: 2, 9: 0, 10: 0}


def test_repeats_inside_one_document_do_not_recur(spark):
    rows = [(1, "\n".join(["the same line of text"] * 40)), (2, "the same line of text")]
    assert check(spark.createDataFrame(rows, "doc_id long, text string")) == {1: 0, 2: 0}


@pytest.mark.parametrize("make", [odd_docs, clashing_docs])
def test_odd_texts(spark, make):
    check(make(spark).select("doc_id", "text"))


def test_real_texts(spark):
    check(spark.read.parquet(f"{SF_TINY}/documents.parquet").select("doc_id", "text"))


def test_empty_table(spark):
    assert lt.digests(empty_docs(spark)).collect() == []


def test_columns_are_kept_and_no_python_runs(spark):
    docs = spark.createDataFrame(logs(), "doc_id long, text string").withColumn("n_lines", F.lit("old")).withColumn("line", F.lit(1))
    out = lt.drop_recurring(docs)
    assert out.columns == ["doc_id", "text", "line", "n_lines", "n_dropped"] and out.count() == 30
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_masking(spark):
    df = spark.createDataFrame([("  a  b12 c\t\td ", ), ("12:30 x9y z", ), ("no digits", ), ("é1 2", )], "line string")
    assert [r[0] for r in df.select(lt.masked(lt.flattened(F.col("line")))).collect()] == ["a <*> c d", "<*> <*> z", "no digits", "<*> <*>"]
