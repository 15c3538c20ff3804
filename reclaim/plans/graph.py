"""The operator graph: every derived table of the engine, built lazily
from the six inputs.

Each attribute is a DataFrame plan; building it runs only the jobs of its
inputs: brand margins are read (one row per brand), shared intermediates and
totals are written or collected once.  The query registry builds one graph per query; the batch pipeline builds one
graph and pins the shared intermediates (scored customers, the queue) so
their consumers do not recompute them.
"""

from __future__ import annotations

from functools import cached_property
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import lazy
from ..operators import (
    actions,
    churn,
    leakage,
    monitoring,
    playbooks,
    quality,
    scenarios,
    segments,
    summaries,
    views,
)
from ..session import materialize
from ..sources import tpch
from .totals import Totals

Scorer = Callable[[DataFrame], DataFrame]


def fixed_scorer(customers: DataFrame) -> DataFrame:
    """Score with the warehouse adapter's fixed churn coefficients."""
    return churn.score_customers(customers, tpch.fixed_score(customers))


class ModelScorer:
    """Score with a logistic model trained on the customers themselves; the
    fitted model is kept for the hold-out metrics."""

    def __init__(self):
        self.model = None

    def __call__(self, customers: DataFrame) -> DataFrame:
        self.model = churn.train_churn_model(customers)
        return churn.churn_train_score(customers, self.model)

    def holdout(self, customers: DataFrame) -> DataFrame:
        if self.model is None:
            self.model = churn.train_churn_model(customers)
        return churn.model_holdout(customers, self.model)


# Tables that join on customer_id.
BY_CUSTOMER = ("enriched", "payment_events", "fulfillment_events")


class Graph:
    def __init__(self, inputs: dict[str, DataFrame], scorer: Scorer = fixed_scorer,
                 queue_limit: int | None = actions.QUEUE_LIMIT, pin: Callable[[DataFrame, str], DataFrame] | None = None,
                 pin_inputs: Iterable[str] = (), pin_queue: bool = True, pin_reports: bool | Iterable[str] = False,
                 pin_by_key: Callable[[DataFrame, str, str], DataFrame] | None = None):
        """``pin(df, name)`` materializes the shared intermediates (the
        enriched customer table, which also serves as the scored table, and
        the action queue); ``None`` leaves every node lazy.  ``pin_inputs``
        names the input tables to materialize on first use (those the
        requested outputs read more than once).  ``pin_reports`` materializes
        short reports that other reports are made of: those named, or all.
        ``pin_by_key(df, name, key)`` materializes the customer-keyed tables
        (``BY_CUSTOMER``), so that they join without a shuffle; by default they
        are pinned like others."""
        self.inputs = inputs
        self.scorer = scorer
        self.queue_limit = queue_limit
        self._pin = pin
        self._pin_inputs = set(pin_inputs) if pin is not None else set()
        self._pin_queue = pin_queue
        self._pin_by_key = pin_by_key
        self.totals = Totals(pin) if pin is not None else None
        self._pin_reports = pin_reports if isinstance(pin_reports, bool) else set(pin_reports)

    def _report(self, df: DataFrame, name: str) -> DataFrame:
        wanted = self._pin_reports if isinstance(self._pin_reports, bool) else name in self._pin_reports
        return self._written(df, name) if wanted and self._pin is not None else df

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a written table, its totals observed on the way."""
        if name == "customers" or self._pin_by_key is not None and name in BY_CUSTOMER:
            # Customers are counted by id, and tables by customer are looked at
            # before they are written: their totals come from the written table.
            return self._keyed_pin(df, name)
        metrics = quality.INPUT_TOTALS | summaries.KPI_TOTALS | views.HEADLINE_TOTALS
        return self.totals.write(df, name, metrics.get(name, list)())

    def _keyed_pin(self, df: DataFrame, name: str) -> DataFrame:
        if self._pin_by_key is not None and name in BY_CUSTOMER:
            return self._pin_by_key(df, name, "customer_id")
        return self._pin(df, name)

    def total(self, df: DataFrame, name: str, metrics: list) -> DataFrame:
        """One-row totals: observed or collected once, where tables are written;
        else a plan."""
        return self.totals.of(df, name, metrics) if self.totals else lazy(df, name, metrics)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return (self._pin or materialize)(df, name)

    def _input(self, name: str) -> DataFrame:
        df = self.inputs[name]
        return self._written(df, name) if name in self._pin_inputs else df

    @classmethod
    def from_warehouse(cls, spark: SparkSession, sf_dir: str, dates: tpch.Dates = tpch.Dates(), **kw) -> "Graph":
        return cls(tpch.load(spark, sf_dir, share=kw.get("pin"), dates=dates), **kw)

    # -- inputs -------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return self._input("customers")

    @cached_property
    def monthly(self) -> DataFrame:
        return self._input("monthly_revenue")

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._input("campaigns")

    @cached_property
    def payments(self) -> DataFrame:
        return self._input("payment_events")

    @cached_property
    def fulfillment(self) -> DataFrame:
        return self._input("fulfillment_events")

    @cached_property
    def skus(self) -> DataFrame:
        return self._input("sku_inventory")

    @cached_property
    def customers_shared(self) -> DataFrame:
        """The customer table, read from the pinned enriched table when
        there is one (same rows, no second pass over the warehouse)."""
        if self._pin is None or "customers" in self._pin_inputs:
            return self.customers
        return self.enriched.select(*self.customers.columns)

    # -- A ------------------------------------------------------------------
    @cached_property
    def quality_gates(self) -> DataFrame:
        return quality.quality_gates(self.customers_shared)

    @cached_property
    def quality_scorecard(self) -> DataFrame:
        return self._report(quality.quality_scorecard(
            self.scored, self.monthly, self.campaigns, self.payments, self.fulfillment, self.skus, total=self.total
        ), "quality_scorecard")

    # -- B ------------------------------------------------------------------
    @cached_property
    def _scored_lazy(self) -> DataFrame:
        return self.scorer(self.customers)

    @cached_property
    def scored(self) -> DataFrame:
        if self._pin is None:
            return self._scored_lazy
        # The pinned enriched table holds every scored column.
        return self.enriched.select(*self._scored_lazy.columns)

    @cached_property
    def holdout(self) -> DataFrame:
        """Hold-out customers with the unrounded fixed-coefficient
        probability (the scored table keeps only the 4-digit score)."""
        c = self.customers_shared
        if hasattr(self.scorer, "holdout"):
            return self.scorer.holdout(c)
        p = churn.sigmoid(tpch.fixed_score(c))
        h = c.where(churn.is_holdout(c)).withColumn("logit", tpch.fixed_score(c)).withColumn("probability", p)
        return h.withColumn("churn_risk_score", churn.rnd(p, churn.SCORE_DIGITS))

    @cached_property
    def model_metrics(self) -> DataFrame:
        return self._report(churn.classification_metrics(self.holdout_shared), "model_metrics")

    @cached_property
    def holdout_shared(self) -> DataFrame:
        """The hold-out feeds both the threshold sweep and the AUC."""
        return self._report(self.holdout.select("churned", "probability", "logit"), "holdout")

    @cached_property
    def run_kpis(self) -> DataFrame:
        return self._report(summaries.run_kpis(
            self.customers_shared, self.quality_gates, self.leakage_report, self.queue, self.playbook_roi,
            self.experiment_backlog, self.segment_opportunity, self.scenario_plan, self.monitoring_summary,
            self.model_metrics, total=self.total,
        ), "run_kpis")

    # -- C ------------------------------------------------------------------
    @cached_property
    def brand_summary(self) -> DataFrame:
        return summaries.brand_summary(self.scored)

    @cached_property
    def channel_summary(self) -> DataFrame:
        return summaries.channel_summary(self.campaigns)

    @cached_property
    def revenue_forecast(self) -> DataFrame:
        return summaries.revenue_forecast(self.monthly)

    # -- D ------------------------------------------------------------------
    @cached_property
    def enriched(self) -> DataFrame:
        out = leakage.margin_at_risk(self._scored_lazy, self.skus)
        return self._keyed_pin(out, "enriched") if self._pin else out

    @cached_property
    def open_failed(self) -> DataFrame:
        return leakage.open_failed_payments(self.payments, self.enriched)

    @cached_property
    def late_orders(self) -> DataFrame:
        return leakage.late_orders(self.fulfillment, self.enriched)

    @cached_property
    def discount_leak(self) -> DataFrame:
        return leakage.discount_leak(self.enriched)

    @cached_property
    def channel_quality(self) -> DataFrame:
        return leakage.channel_quality(self.enriched)

    @cached_property
    def weak_campaigns(self) -> DataFrame:
        return leakage.weak_campaigns(self.campaigns, self.channel_quality)

    @cached_property
    def sku_risk(self) -> DataFrame:
        return leakage.sku_risk(self.skus)

    @cached_property
    def inventory_risk(self) -> DataFrame:
        return leakage.inventory_risk(self.skus)

    @cached_property
    def support_leak(self) -> DataFrame:
        return leakage.support_escalation(self.enriched)

    @cached_property
    def leakage_report(self) -> DataFrame:
        return self._report(leakage.leakage_report(
            self.open_failed, self.late_orders, self.discount_leak, self.weak_campaigns,
            self.inventory_risk, self.support_leak,
        ), "leakage_report")

    @cached_property
    def payment_recovery(self) -> DataFrame:
        return leakage.payment_recovery(self.payments)

    @cached_property
    def weekly_brief(self) -> DataFrame:
        return leakage.weekly_brief(self.leakage_report)

    # -- E ------------------------------------------------------------------
    @cached_property
    def action_items(self) -> DataFrame:
        return actions.action_items(self.open_failed, self.late_orders, self.discount_leak, self.support_leak)

    @cached_property
    def reduced_items(self) -> DataFrame:
        """Items reduced per (customer, brand, issue, reason); the queue's
        four roll-up branches read it, so it is materialized when pinning."""
        out = actions.reduce_items(self.action_items)
        return self._pin(out, "reduced_items") if self._pin else out

    @cached_property
    def queue(self) -> DataFrame:
        out = actions.roll_up(self.reduced_items, self.queue_limit, self.write)
        return self._written(out, "queue") if self._pin and self._pin_queue else out

    # -- F ------------------------------------------------------------------
    @cached_property
    def issue_allocation(self) -> DataFrame:
        return playbooks.explode_issues(self.queue)

    @cached_property
    def playbook_roi(self) -> DataFrame:
        # By bitmaps where others of the run need them as well.
        made = self.customer_bitmaps if self._pin_reports is True else None
        return self._report(playbooks.playbook_roi(self.queue, made), "playbook_roi")

    @cached_property
    def experiment_backlog(self) -> DataFrame:
        return playbooks.experiment_backlog(self.playbook_roi)

    @cached_property
    def owner_workload(self) -> DataFrame:
        return playbooks.owner_workload(self.playbook_roi)

    # -- G ------------------------------------------------------------------
    @cached_property
    def base_segments(self) -> DataFrame:
        return segments.base_segments(self.scored)

    @cached_property
    def queue_context(self) -> DataFrame:
        return segments.queue_context(self.queue, self.scored)

    @cached_property
    def customer_bitmaps(self) -> DataFrame | None:
        """Customers of each segment and issue, for runs over the whole queue
        and batch runs; a short queue is counted as it is."""
        if self._pin is None or self.queue_limit is not None and self._pin_reports is not True:
            return None
        made = segments.customer_bitmaps(self.queue_context)
        return None if made is None else self._pin(made, "customer_bitmaps")

    @cached_property
    def queue_by_segment(self) -> DataFrame:
        return segments.queue_by_segment(self.queue_context, self.customer_bitmaps)

    @cached_property
    def dominant_issue(self) -> DataFrame:
        return segments.dominant_issue(self.queue_context)

    @cached_property
    def segment_opportunity(self) -> DataFrame:
        return self._report(segments.segment_opportunity(self.base_segments, self.queue_context, write=self.write, made=self.customer_bitmaps), "segment_opportunity")

    @cached_property
    def issue_matrix(self) -> DataFrame:
        return segments.issue_matrix(self.queue_context, made=self.customer_bitmaps)

    # -- H ------------------------------------------------------------------
    @cached_property
    def metric_changes(self) -> DataFrame:
        return self._report(monitoring.metric_changes(self.monthly), "metric_changes")

    @cached_property
    def revenue_alerts(self) -> DataFrame:
        return monitoring.revenue_alerts(self.metric_changes)

    @cached_property
    def churn_alerts(self) -> DataFrame:
        return monitoring.churn_alerts(self.metric_changes)

    @cached_property
    def campaign_alerts(self) -> DataFrame:
        return monitoring.campaign_alerts(self.campaigns)

    @cached_property
    def payment_alerts(self) -> DataFrame:
        # Only (customer_id, brand) is needed: no scoring, no margin.
        return monitoring.payment_alerts(self.customers_shared if "enriched" in self.__dict__ else self.customers, self.payments)

    @cached_property
    def fulfillment_alerts(self) -> DataFrame:
        return monitoring.fulfillment_alerts(self.fulfillment)

    @cached_property
    def inventory_alerts(self) -> DataFrame:
        return monitoring.inventory_alerts(self.skus)

    @cached_property
    def alert_sources(self) -> list[DataFrame]:
        return [
            self.revenue_alerts, self.churn_alerts, self.campaign_alerts,
            self.payment_alerts, self.fulfillment_alerts, self.inventory_alerts,
        ]

    @cached_property
    def alert_list(self) -> DataFrame:
        return self._report(monitoring.alert_list(*self.alert_sources, write=self.write), "alert_list")

    @cached_property
    def monitoring_summary(self) -> DataFrame:
        """From the written list where there is one, else from the sources:
        the summary needs no ranks."""
        alerts = self.alert_list if "alert_list" in self.__dict__ else monitoring.all_alerts(*self.alert_sources)
        return monitoring.monitoring_summary(alerts, self.quality_scorecard, self.total)

    @cached_property
    def headline_kpis(self) -> DataFrame:
        return views.headline_kpis(self.payment_recovery, self.sku_risk, self.playbook_roi, self.queue, self.total)

    # -- J ------------------------------------------------------------------
    @cached_property
    def scored_actions(self) -> DataFrame:
        return scenarios.scored_actions(self.queue)

    @cached_property
    def scenario_actions(self) -> DataFrame:
        return self._report(scenarios.scenario_actions(self.scored_actions), "scenario_actions")

    @cached_property
    def scenario_plan(self) -> DataFrame:
        return self._report(scenarios.scenario_plan(self.scenario_actions), "scenario_plan")

    @cached_property
    def scenario_workload(self) -> DataFrame:
        return scenarios.scenario_workload(self.scenario_actions)

    @cached_property
    def scenario_summary(self) -> DataFrame:
        return scenarios.scenario_summary(self.scenario_plan)

    # -- K ------------------------------------------------------------------
    @cached_property
    def queue_enriched(self) -> DataFrame:
        return views.enrich_queue(self.queue)
