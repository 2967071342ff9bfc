"""Subscription time windows: the effective end date and the monthly grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import as_of_literal, flag, month_start, months_between_bounds

EFFECTIVE_COLUMNS = ["subscription_id", "customer_id", "plan_name", "monthly_price", "status",
                     "start_date", "end_date", "effective_end_date",
                     "effective_end_date_is_inferred", "had_negative_price_defect",
                     "has_valid_customer"]
MONTHLY_COLUMNS = ["subscription_id", "customer_id", "plan_name", "monthly_price",
                   "month_start", "month_end_exclusive"]


def invoice_rollup(invoices: DataFrame, statuses=("paid", "open", "failed")) -> DataFrame:
    """Per subscription_id: last invoice date, invoice count and EUR totals by
    status.  Aggregating invoices *before* any join means only
    subscription-sized data is shuffled into the joins; the partial aggregate
    also collapses a hot subscription map-side.  Unused outputs are pruned by
    Catalyst, so callers needing one column pay for one column."""
    aggs = [F.max("invoice_date").alias("last_invoice_date"),
            F.count(F.lit(1)).alias("invoice_count")]
    for s in statuses:
        aggs.append(F.sum(F.when(F.col("status") == s, F.col("amount_eur")).otherwise(F.lit(0)))
                    .alias(f"total_{s}_eur"))
    return invoices.groupBy("subscription_id").agg(*aggs)


def effective_dates(subscriptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """See ``effective_window``; keeps every EFFECTIVE_COLUMNS column the
    input has (``has_valid_customer`` is optional)."""
    out = effective_window(subscriptions, invoices)
    return out.select(*[c for c in EFFECTIVE_COLUMNS if c in out.columns])


def effective_window(subscriptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """``effective_end_date = coalesce(end_date, last invoice date if cancelled)``.

    ``effective_end_date_is_inferred`` is true for every cancelled
    subscription without an end date, even when no invoice was found (then
    the effective end stays NULL and the subscription counts as active).
    """
    last = invoice_rollup(invoices).select("subscription_id", "last_invoice_date")
    cancelled = F.col("status") == F.lit("cancelled")
    return (subscriptions.join(last, "subscription_id", "left")
            .withColumn("effective_end_date",
                        F.coalesce(F.col("end_date"),
                                   F.when(cancelled, F.col("last_invoice_date"))))
            .withColumn("effective_end_date_is_inferred", flag(F.col("end_date").isNull() & cancelled))
            .drop("last_invoice_date"))


def active_month_bounds(eff: DataFrame, as_of) -> DataFrame:
    """Add ``_lo`` / ``_hi``: the first and last month a subscription is
    active, clipped to the as-of month.  A subscription counts in month M when
    it starts before M ends and its effective end is NULL or on/after M's
    first day (an end on the 1st still counts for that month)."""
    as_of_month = month_start(as_of_literal(as_of))
    hi = F.least(F.coalesce(month_start("effective_end_date"), as_of_month), as_of_month)
    return eff.withColumn("_lo", month_start("start_date")).withColumn("_hi", hi)


def subscription_months(eff: DataFrame, as_of) -> DataFrame:
    """One row per subscription per month it was active, through ``as_of``.

    The reference joins a month spine with a range predicate, which Spark can
    only run as a nested-loop join; generating each subscription's own month
    range with ``explode(sequence(...))`` gives the same rows with no join
    and no shuffle.  Future starts and NULL starts produce no rows.
    """
    b = active_month_bounds(eff, as_of)
    return (b.select("subscription_id", "customer_id", "plan_name", "monthly_price",
                     F.explode(months_between_bounds(F.col("_lo"), F.col("_hi"))).alias("month_start"))
            .withColumn("month_end_exclusive", F.add_months("month_start", 1))
            .select(*MONTHLY_COLUMNS))
