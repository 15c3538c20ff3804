"""Totals observed at write time, the numbered queue, tables by customer,
bitmaps, run days, quarantine and report days."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reclaim import session
from reclaim.functions import bitmaps
from reclaim.operators import actions, history, monitoring, quality
from reclaim.plans import pipeline, registry
from reclaim.plans.graph import Graph, fixed_scorer
from reclaim.plans.totals import Totals
from reclaim.sources import io, schemas, tpch

from conftest import SF_SMALL
from test_actions import HAND_ITEMS, ITEM_SCHEMA

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="warehouse fixture not available")


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


# -- totals -------------------------------------------------------------------
def test_totals_are_observed_by_the_write(spark):
    metrics = lambda: [F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.max(F.col("x").cast("decimal(20,4)")).alias("m")]
    for rows in ([(i,) for i in range(10)], []):
        df = spark.createDataFrame(rows, "x long")
        t = Totals(session.materialize)
        out = t.write(df, "a", metrics())
        got = t.of(out.where("1 / 0 > 1"), "a", metrics())  # the frame is not looked at again
        assert got.collect() == df.agg(*metrics()).collect()
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in df.agg(*metrics()).schema]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "ExistingRDD" not in plan


@pytest.mark.parametrize("name", ["quality_scorecard", "monitoring_summary", "alert_headline", "run_kpis", "headline_kpis"])
def test_reports_of_totals_scan_nothing(spark, name):
    plan = final_plan(registry.queries()[name](spark, SF_SMALL))
    assert "FileScan" not in plan and "Exchange hash" not in plan


def test_batch_run_observes_inputs_and_reports(spark):
    seen = []

    class Spy(Totals):
        def of(self, df, name, metrics):
            seen.append((name, name in self._rows))
            return super().of(df, name, metrics)

    g = Graph.from_warehouse(spark, SF_SMALL, pin=session.materialize, pin_inputs=registry.ALL_INPUTS, pin_reports=True)
    g.totals.__class__ = Spy
    g.run_kpis.collect()
    observed = {name for name, there in seen if there}
    assert {"monthly_revenue", "campaigns", "payment_events", "fulfillment_events", "sku_inventory", "queue", "leakage_report", "playbook_roi",
            "segment_opportunity", "scenario_plan"} <= observed


# -- queue --------------------------------------------------------------------
def test_whole_queue_has_fixed_width_buffers(spark):
    plan = final_plan(registry.queries()["action_queue_full"](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_places_order_items_as_texts_do(spark):
    items = actions.reduce_items(spark.createDataFrame(HAND_ITEMS + [(9, "Z", "late_fulfillment", -3.0, None, None, 2)], ITEM_SCHEMA))
    texts = actions.dictionary(items)
    assert [r.code for r in texts.orderBy("code").collect()] == list(range(1, texts.count() + 1))
    got = actions.numbered(items, texts)
    assert got.count() == items.count()
    by_place = [(r.customer_id, actions_code) for r, actions_code in ((r, int(r.place) % actions.CODES) for r in got.orderBy("place").collect())]
    by_text = items.join(texts, [items[c].eqNullSafe(texts[c]) for c in actions.TEXTS]).orderBy(F.col("top").desc_nulls_last(), "code")
    assert by_place == [(r.customer_id, r.code) for r in by_text.select("customer_id", "code").collect()]


# -- tables by customer -------------------------------------------------------
@pytest.mark.parametrize("name", ["late_orders", "open_failed_payments", "action_items"])
def test_customer_joins_without_an_exchange(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.queries()[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_hot_customer_is_not_bucketed(spark):
    even = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    hot = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(1)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
    for df, bucketed in ((even, True), (hot, False)):
        out = session.materialize_by_key(df, "t", "k", buckets=8)
        assert sorted(out.collect()) == sorted(df.collect())
        assert ("Bucketed: true" in out.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()) == bucketed
    assert session.materialize_by_key(even.limit(0), "t", "k", buckets=8).count() == 0


# -- bitmaps ------------------------------------------------------------------
def test_bitmaps_count_like_distinct(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), ((F.col("id") * 7919) % 1200 * 100_003 - 500).alias("who"))
    df = df.union(spark.sql("select 0L, 0L, cast(null as bigint)")).union(spark.sql("select null, 9L, 4L"))
    made = bitmaps.bitmaps(df, ["a", "b"], "who")
    for keys in (["a", "b"], ["a"], ["b"]):
        got = {tuple(r) for r in bitmaps.distinct_ids(made, keys, "n").collect()}
        assert got == {tuple(r) for r in df.where("who is not null").groupBy(*keys).agg(F.countDistinct("who")).collect()}
    assert not bitmaps.countable(df.select(F.col("who").cast("string")), "who")


# -- monthly baseline ---------------------------------------------------------
def test_baseline_reads_revenue_once(spark):
    plan = final_plan(registry.queries()["metric_changes"](spark, SF_SMALL))
    assert plan.split("== Initial Plan ==")[0].count("Exchange SinglePartition") == 1
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 2  # orders and customer


def test_baseline_with_gaps_and_late_brands(spark):
    rows = [(dt.date(2024, m, 1), b, 10 * m, 100.0 * m, 0.1 * m) for m in (1, 2, 4, 5) for b in ("A", None)]
    rows += [(dt.date(2024, 3, 1), "old", 1, 1.0, 0.1), (dt.date(2024, 5, 1), "new", 1, 1.0, 0.1)]
    got = {r.brand: r for r in monitoring.metric_changes(spark.createDataFrame(rows, schemas.INPUTS["monthly_revenue"])).collect()}
    assert set(got) == {"A", None, "new"}
    assert got["A"].baseline_revenue == (200.0 + 400.0) / 2 and got["A"].baseline_active_customers == 30.0  # February and April
    assert got["new"].baseline_revenue is None and got[None].baseline_revenue is None


# -- run days -----------------------------------------------------------------
def test_orders_after_the_run_day_never_count(spark, tmp_path):
    past = tpch.Dates(days_back=200)
    wh = tpch.Warehouse(spark, SF_SMALL, dates=past)
    for name in ("region", "nation", "customer", "part", "lineitem"):
        wh.table(name).write.parquet(str(tmp_path / f"{name}.parquet"))
    wh.orders_before().write.parquet(str(tmp_path / "orders.parquet"))  # a warehouse without later orders
    then = tpch.load(spark, str(tmp_path), dates=tpch.Dates(as_of=wh.as_of))
    now = tpch.load(spark, SF_SMALL, dates=past)
    assert wh.as_of < tpch.Warehouse(spark, SF_SMALL).as_of
    for table in ("customers", "payment_events", "fulfillment_events", "monthly_revenue", "campaigns"):
        assert sorted(map(repr, now[table].collect())) == sorted(map(repr, then[table].collect())), table


# -- quarantine ---------------------------------------------------------------
def test_malformed_lines_are_set_apart(spark, tmp_path):
    good = ["1,A,R,email,monthly,3,1,10.0,0.1,0,0,0.5,30.0,0", "2,A,R,email,monthly,3,1,,0.1,0,0,0.5,30.0,1"]
    bad = ["3,A,R,email,monthly,three,1,10.0,0.1,0,0,0.5,30.0,0", "4,A,R", "5,A,R,email,monthly,3,1,10.0,0.1,0,0,0.5,30.0,0,extra,more"]
    (tmp_path / "customers.csv").write_text("\n".join([",".join(schemas.INPUTS["customers"].names), good[0], bad[0], bad[1], good[1], bad[2]]) + "\n")
    got = io.read_csv_checked(spark, str(tmp_path / "customers.csv"), "customers")
    assert got.rows.schema.names == schemas.INPUTS["customers"].names
    assert sorted(r.customer_id for r in got.rows.collect()) == ["1", "2"]
    assert sorted(r.line for r in got.quarantine.collect()) == sorted(bad)
    assert got.rows.select("brand").distinct().count() == 1  # pruned reads see the same rows
    gate = quality.quarantine_gate({"customers": got}).first()
    assert tuple(gate) == ("customers", 5, 2, 3, False)
    with pytest.raises(ValueError, match="customers"):
        quality.check_quarantine({"customers": got})
    quality.check_quarantine({"customers": got}, most=0.6)


# -- report days --------------------------------------------------------------
@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_a_rerun_replaces_one_day_only(spark, tmp_path, fmt):
    out, one, two = str(tmp_path), dt.date(2024, 5, 1), dt.date(2024, 5, 2)
    df = spark.sql("select 1L as a, cast(2 as int) as b, cast(1.5 as double) as c, date'2024-01-02' as d, '' as e, cast(null as string) as f, true as g")
    io.put_report(df, out, "r", fmt, one)
    io.put_report(df.withColumn("a", F.lit(7).cast("long")), out, "r", fmt, two)
    io.put_report(df.withColumn("a", F.lit(8).cast("long")), out, "r", fmt, two)
    read = [io.get_report(spark, out, "r", fmt, day) for day in (one, two)]
    assert [r.a for r in read[0].union(read[1]).orderBy("a").collect()] == [1, 8]
    assert read[0].dtypes == df.dtypes and read[0].collect() == df.collect()
    io.put_report(df.limit(0), out, "r", fmt, two)
    assert io.get_report(spark, out, "r", fmt, two).count() == 0 and io.get_report(spark, out, "r", fmt, one).count() == 1


def test_five_reports_across_two_days(spark):
    out = tempfile.mkdtemp(prefix="reclaim-days-")
    days = []
    for back in (30, 0):
        inputs = tpch.load(spark, SF_SMALL, share=session.materialize, dates=tpch.Dates(days_back=back))
        days.append(inputs.wh.as_of)
        pipeline.run(spark, inputs, out_dir=out, reports=list(pipeline.COMPARED), fmt="csv", run_day=days[-1], validate=False, scorer=fixed_scorer)
    changed = pipeline.day_changes(spark, out, *days, fmt="csv")
    assert len(changed) == 5
    reports = [{n: io.get_report(spark, out, n, "csv", d) for n in changed} for d in days]
    for name, (keys, values) in pipeline.COMPARED.items():
        rows = changed[name].collect()
        kept = [{tuple(r[k] for k in keys): r for r in day[name].collect()} for day in reports]
        assert {tuple(r[k] for k in keys) for r in rows} == set(kept[0]) | set(kept[1])
        for r in rows:
            a, b = (side.get(tuple(r[k] for k in keys)) for side in kept)
            same = a is not None and b is not None and all(a[v] == b[v] for v in values)
            assert r.change == ("new" if a is None else "gone" if b is None else "same" if same else "changed")
            assert all(r[f"{v}_before"] == (a and a[v]) and r[f"{v}_after"] == (b and b[v]) for v in values)
    assert any(r.change == "changed" for r in changed["revenue_leakage_report"].collect())


def test_day_changes_match_missing_keys(spark):
    a = spark.createDataFrame([(None, 1.0), ("x", 2.0), ("y", None)], "k string, v double")
    b = spark.createDataFrame([(None, 1.0), ("x", 5.0), ("z", 4.0)], "k string, v double")
    got = sorted(map(tuple, history.day_changes(a, b, ["k"], ["v"]).collect()), key=repr)
    assert got == sorted([(None, "same", 1.0, 1.0, 0.0), ("x", "changed", 2.0, 5.0, 3.0), ("y", "gone", None, None, None), ("z", "new", None, 4.0, None)], key=repr)


def test_extracts_with_broken_lines_run_to_the_end(spark):
    folder, out = tempfile.mkdtemp(prefix="reclaim-extracts-"), tempfile.mkdtemp(prefix="reclaim-reports-")
    inputs = tpch.load(spark, SF_SMALL)
    for table, schema in schemas.INPUTS.items():
        path = os.path.join(folder, f"{table}.csv")
        rows = inputs[table].select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).toPandas()
        rows.to_csv(path, index=False)
        if table == "sku_inventory":
            with open(path, "a") as f:
                f.write("broken line\n")
    pipeline.run_extracts(spark, folder, out, most_malformed=0.05, reports=["sku_risk_report", "brand_summary"], scorer=fixed_scorer)
    assert [r.line for r in io.get_report(spark, out, "quarantined_lines").collect()] == ["broken line"]
    assert io.get_report(spark, out, "sku_risk_report").count() == inputs["sku_inventory"].count()
    with pytest.raises(ValueError, match="sku_inventory"):
        pipeline.run_extracts(spark, folder, out, most_malformed=0.0)
