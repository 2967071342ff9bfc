"""The billing model graph as lazily built DataFrames.

raw → staging → effective dates → monthly grain → marts.  Each model is
built once per ``BillingModels`` instance; nothing executes until an action.
``materialize=...`` (or ``plans.pipeline.run``) materialises the models that
feed several consumers so a full run computes them once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.fx import FIXED_EUR_RATES
from ledgerline.session import stored
from ledgerline.operators import metrics, periods, staging
from ledgerline.operators.existence import existence_flag


class BillingModels:
    def __init__(self, raw: dict[str, DataFrame], as_of, rates=FIXED_EUR_RATES,
                 materialize: bool | set[str] = False):
        """``materialize=True`` writes every model as it is first built (Parquet
        under ``spark.checkpoint.dir``), so a job with many consumers per
        model — the check suite, a full run — computes each model once and reads
        back the columns it needs, with the lineage cut.  A set of names
        materialises only those (the widely shared ones)."""
        self.raw = raw
        self.as_of = as_of
        self.rates = rates
        self.materialize = materialize

    def _m(self, name: str, df: DataFrame) -> DataFrame:
        if self.materialize is True or (self.materialize and name in self.materialize):
            return stored(df, name)
        return df

    # staging ---------------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._m("stg_customers", staging.clean_customers(self.raw["customers"]))

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return self._m("stg_subscriptions", staging.clean_subscriptions(self.raw["subscriptions"], self.raw["customers"]))

    @cached_property
    def subscriptions_core(self) -> DataFrame:
        # stg_subscriptions without the customer existence flag (and its
        # shuffle on customer_id): the activity / MRR / churn path never reads it.
        if self._shared("stg_subscriptions"):
            return self.stg_subscriptions
        return staging.dedup_subscriptions(self.raw["subscriptions"])

    @cached_property
    def effective_core(self) -> DataFrame:
        if self._shared("effective_dates"):
            return self.effective_dates
        return periods.effective_dates(self.subscriptions_core, self._invoices_for_metrics())

    @cached_property
    def typed_invoices(self) -> DataFrame:
        # Row-wise part of stg_invoices (no existence flag): what the revenue
        # and effective-date models read, so they skip a join they never use.
        return staging.type_invoices(self.raw["invoices"], self.rates)

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return self._m("stg_invoices", staging.flag_invoices(self.typed_invoices, self.raw["subscriptions"]))

    def _shared(self, name: str) -> bool:
        return self.materialize is True or bool(self.materialize and name in self.materialize)

    def _invoices_for_metrics(self) -> DataFrame:
        # With materialisation on, the written stg_invoices is cheaper to read
        # than re-typing raw; otherwise use the flag-free typed form.
        return self.stg_invoices if self._shared("stg_invoices") else self.typed_invoices

    # intermediate ----------------------------------------------------------
    @cached_property
    def effective_dates(self) -> DataFrame:
        if self._shared("stg_subscriptions"):  # written with its flag: nothing to derive again
            return self._m("effective_dates", periods.effective_dates(self.stg_subscriptions, self._invoices_for_metrics())
                           .select(*periods.EFFECTIVE_COLUMNS))
        # Join the invoice rollup while subscriptions are still hash-partitioned on
        # subscription_id (the dedup shuffle), then add the customer flag.
        eff = periods.effective_dates(staging.dedup_subscriptions(self.raw["subscriptions"]),
                                      self._invoices_for_metrics())
        flagged = existence_flag(eff, "customer_id", self.raw["customers"], "customer_id",
                                 "has_valid_customer")
        return self._m("effective_dates", flagged.select(*periods.EFFECTIVE_COLUMNS))

    @cached_property
    def subscription_months(self) -> DataFrame:
        return self._m("subscription_months", periods.subscription_months(self.effective_core, self.as_of))

    @cached_property
    def churn_base(self) -> DataFrame:
        return self._m("churn_base", metrics.churn_base(self.effective_core, self.as_of))

    @cached_property
    def customer_revenue(self) -> DataFrame:
        return self._m("customer_revenue", metrics.customer_revenue(self._invoices_for_metrics(), self.subscriptions_core))

    @cached_property
    def subscription_summary(self) -> DataFrame:
        # Same rows as filtering effective_dates (a 1:1 left join), but reading
        # staging directly skips the invoice join the summary does not need.
        return self._m("subscription_summary", metrics.subscription_summary(self.stg_subscriptions))

    # marts -----------------------------------------------------------------
    @cached_property
    def mrr_by_month_plan(self) -> DataFrame:
        # The mart uses the running-sum form (same rows as aggregating the
        # monthly grain, at a cost that does not grow with lifetimes);
        # ``mrr_from_grain`` keeps the grain-based formulation.
        return self._m("mrr_by_month_plan", metrics.mrr_running_sum(self.effective_core, self.as_of))

    @cached_property
    def mrr_from_grain(self) -> DataFrame:
        return self._m("mrr_from_grain", metrics.mrr_by_month_plan(self.subscription_months))

    @cached_property
    def mrr_running_sum(self) -> DataFrame:
        return self.mrr_by_month_plan  # the mart is this form

    @cached_property
    def churn_rates(self) -> DataFrame:
        return self._m("churn_rates", metrics.churn_rates(self.churn_base))

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return self._m("customer_ltv", metrics.customer_ltv(
            self.stg_customers, metrics.customer_rollup(self._invoices_for_metrics(), self._ltv_subscriptions())))

    def _ltv_subscriptions(self) -> DataFrame:
        # Every customer the LTV mart keeps is a raw customer id, so all of its
        # subscriptions have has_valid_customer = true: the flag (and the
        # shuffle on customer_id that computes it) can be skipped here.
        if self._shared("stg_subscriptions"):
            return self.stg_subscriptions
        return self.subscriptions_core.withColumn("has_valid_customer", F.lit(True))

    def build(self, levels: list[list[str]]) -> None:
        """Build models level by level; the models of one level are
        independent and are built concurrently (one Spark job per model from
        a driver thread), so jobs that cannot fill the cluster on their own
        run side by side."""
        from concurrent.futures import ThreadPoolExecutor

        for level in levels:
            if len(level) == 1:
                self.model(level[0])
                continue
            with ThreadPoolExecutor(max_workers=len(level)) as pool:
                list(pool.map(self.model, level))

    def model(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.raw[name[len("raw_"):]]
        return getattr(self, name)


# Presentation order of the marts (total orders: ties broken by the key);
# "-" marks a descending column.
PRESENTATION_ORDER = {
    "mrr_by_month_plan": ["month_start", "plan_name"],
    "churn_rates": ["month_start"],
    "churn_base": ["month_start"],
    "customer_ltv": ["-ltv", "customer_id"],
}


def present(df: DataFrame, model: str) -> DataFrame:
    """Sort a mart for display.  Stored models carry no order (a sort is a
    range shuffle of the whole table), so ordering is applied only when a
    result is read for presentation."""
    order = presentation_order(model)
    return df.orderBy(*order) if order else df


def presentation_order(model: str) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in PRESENTATION_ORDER.get(model, [])]
