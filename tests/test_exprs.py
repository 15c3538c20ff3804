from pyspark.sql import functions as F

from reclaim.functions.exprs import exact_avg, exact_sum, max0, pct_text, precise_sum, rnd, safe_div


def test_round_half_even_after_scaling(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (0.125,), (-0.00001,), (2.675,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 2)).collect()]
    # 1.005*100 = 100.4999.. -> 1.0; 0.125*100 = 12.5 -> 12 (even); -0.0 -> 0.0
    assert got == [1.0, 2.5, 0.12, 0.0, 2.68]
    assert str(got[3]) == "0.0"


def test_percent_text_and_guards(spark):
    df = spark.createDataFrame([(0.385, 0.0, None), (0.5, 2.0, -1.0)], "a double, b double, c double")
    out = df.select(pct_text("a"), safe_div(F.lit(1.0), "b"), max0("c")).collect()
    assert out[0][0] == "38%" and out[1][0] == "50%"
    assert out[0][1] is None and out[1][1] == 0.5
    assert out[0][2] is None and out[1][2] == 0.0


def test_fixed_point_sums_do_not_depend_on_order(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 7
    a = spark.createDataFrame(vals, "x double").repartition(5)
    b = spark.createDataFrame(list(reversed(vals)), "x double").coalesce(1)
    for f in (exact_sum, precise_sum, exact_avg):
        assert a.agg(f("x")).first()[0] == b.agg(f("x")).first()[0]
    assert a.agg(exact_sum("x")).first()[0] == 4.2
    empty = spark.createDataFrame([], "x double")
    assert empty.agg(exact_sum("x")).first()[0] == 0.0
