"""Marts: MRR by month and plan, churn, customer revenue, plan summary, LTV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import MONEY_SUM, as_of_literal, month_start, round_ratio
from ledgerline.operators.periods import active_month_bounds, invoice_rollup


def mrr_by_month_plan(months: DataFrame) -> DataFrame:
    """Sum of ``monthly_price`` and number of active subscriptions per
    (month_start, plan_name) over the monthly grain.

    subscription_id is unique within a (month, plan) group, so ``count``
    equals the reference's ``count(distinct …)`` without the extra
    distinct-expansion shuffle."""
    return (months.groupBy("month_start", "plan_name")
            .agg(F.sum("monthly_price").cast(MONEY_SUM).alias("mrr"),
                 F.count("subscription_id").alias("active_subscriptions")))


def mrr_deltas(eff: DataFrame, as_of=None) -> DataFrame:
    """(plan_name, m, dr, dn, dp, dv): by how much each month's active rows,
    subscriptions (a NULL id is a row, but no subscription), MRR and priced rows
    differ from the month before.

    Each subscription emits +1/+price in its first active month and −1/−price
    in the month after its last one; the partial aggregate leaves at most
    plans × months rows to shuffle.  Without ``as_of`` the deltas reach as far as
    the data, so they can be stored, added to, and read for any as-of month.
    """
    if as_of is None:
        b = eff.withColumn("_lo", month_start("start_date")).withColumn("_hi", month_start("effective_end_date"))
        closes = F.col("_hi").isNotNull()
    else:
        b = active_month_bounds(eff, as_of)
        closes = F.col("_hi") < month_start(as_of_literal(as_of))
    b = b.where(F.col("_lo").isNotNull() & (F.col("_hi").isNull() | (F.col("_lo") <= F.col("_hi"))))
    price = F.col("monthly_price")
    has_price = F.when(price.isNotNull(), 1).otherwise(0)
    has_id = F.when(F.col("subscription_id").isNotNull(), 1).otherwise(0)
    events = b.select(
        "plan_name",
        F.explode(F.array(
            F.struct(F.col("_lo").alias("m"), F.lit(1).alias("dr"), has_id.alias("dn"), price.alias("dp"),
                     has_price.alias("dv")),
            F.when(closes,
                   F.struct(F.add_months("_hi", 1).alias("m"), F.lit(-1).alias("dr"), (-has_id).alias("dn"),
                            (-price).alias("dp"), (-has_price).alias("dv"))),
        )).alias("e")).where(F.col("e").isNotNull()).select("plan_name", "e.*")
    return events.groupBy("plan_name", "m").agg(
        F.sum("dr").alias("dr"), F.sum("dn").alias("dn"), F.sum("dp").alias("dp"), F.sum("dv").alias("dv"))


def mrr_levels(deltas: DataFrame, as_of) -> DataFrame:
    """MRR and active subscriptions per month and plan up to ``as_of``: a running
    sum of the deltas, each level spread over the months until the next change."""
    as_of_month = month_start(as_of_literal(as_of))
    deltas = deltas.where(F.col("m") <= as_of_month)
    w = Window.partitionBy("plan_name").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    levels = deltas.select(
        "plan_name", "m",
        F.sum("dr").over(w).alias("r"),
        F.sum("dn").over(w).alias("n"),
        F.sum("dp").over(w).alias("p"),
        F.sum("dv").over(w).alias("v"),
        F.lead("m").over(Window.partitionBy("plan_name").orderBy("m")).alias("next_m"))
    last = F.coalesce(F.add_months("next_m", -1), as_of_month)
    return (levels.where(F.col("r") > 0)
            .select(F.explode(F.sequence("m", last, F.expr("INTERVAL 1 MONTH"))).alias("month_start"),
                    "plan_name",
                    F.when(F.col("v") > 0, F.col("p")).cast(MONEY_SUM).alias("mrr"),
                    F.col("n").cast("long").alias("active_subscriptions")))


def mrr_running_sum(eff: DataFrame, as_of) -> DataFrame:
    """Same result as ``mrr_by_month_plan(subscription_months(eff))`` without
    materialising the monthly grain; cost grows with the number of
    subscriptions, not with their lifetimes."""
    return mrr_levels(mrr_deltas(eff, as_of), as_of)


def churn_base(eff: DataFrame, as_of) -> DataFrame:
    """Per activity month M: subscriptions/MRR active in M−1 (the base) and
    cancelled subscriptions whose effective end falls in M (churned).

    Only months with any activity appear (a gap month vanishes); missing
    values are 0.  One pass over the effective dates: every subscription
    emits tagged events — +1/+price when it becomes active, −1/−price the
    month after it stops, and a churn event in its end month — which one
    partial aggregate reduces to months × kinds rows.  A running sum over
    that month-sized table gives the activity level per month; everything
    after the aggregate is month-sized, so no join or window ever sees the
    subscription rows.
    """
    b = active_month_bounds(eff, as_of)
    as_of_month = month_start(as_of_literal(as_of))
    price = F.col("monthly_price")
    has_price = F.when(price.isNotNull(), 1).otherwise(0)
    has_id = F.when(F.col("subscription_id").isNotNull(), 1).otherwise(0)  # a NULL id is a row, but no subscription
    active = F.col("_lo").isNotNull() & (F.col("_lo") <= F.col("_hi"))
    churned = (F.col("status") == "cancelled") & F.col("effective_end_date").isNotNull()

    def ev(kind, cond, m, sign):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), m.alias("m"), F.lit(sign).alias("dr"),
                                     (has_id * sign).alias("dn"), (price * sign).alias("dp"), (has_price * sign).alias("dv")))

    events = b.select(F.explode(F.array(
        ev(0, active, F.col("_lo"), 1),
        ev(0, active & (F.col("_hi") < as_of_month), F.add_months("_hi", 1), -1),
        ev(1, churned, month_start("effective_end_date"), 1),
    )).alias("e")).where(F.col("e").isNotNull()).select("e.*")
    # One row per event month.  Everything below is a single linear chain on
    # month-sized data: branching here would let column pruning give each
    # branch a different aggregate and re-run the whole upstream per branch.
    def part(kind, col):
        return F.sum(F.when(F.col("kind") == kind, F.col(col)))

    monthly = events.groupBy("m").agg(
        part(0, "dr").alias("a_r"), part(0, "dn").alias("a_n"), part(0, "dp").alias("a_p"), part(0, "dv").alias("a_v"),
        part(1, "dn").alias("c_n"), part(1, "dp").alias("c_p"), part(1, "dv").alias("c_v"))
    # Windows without a partition key: the input is bounded by the calendar
    # (months between the first start and as_of), not by the data.
    w = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    levels = monthly.select(
        "m", "c_n", "c_p", "c_v",
        F.sum(F.coalesce("a_r", F.lit(0))).over(w).alias("r"),
        F.sum(F.coalesce("a_n", F.lit(0))).over(w).alias("n"),
        F.sum(F.coalesce("a_p", F.lit(0))).over(w).alias("p"),
        F.sum(F.coalesce("a_v", F.lit(0))).over(w).alias("v"),
        F.lead("m").over(Window.orderBy("m")).alias("next_m"))
    last = F.least(F.coalesce(F.add_months("next_m", -1), as_of_month), as_of_month)
    spread = (levels.where(F.col("m") <= as_of_month)
              .select(F.explode(F.sequence("m", F.greatest("m", last), F.expr("INTERVAL 1 MONTH")))
                      .alias("month_start"), "*")
              .where(F.col("r") > 0))
    first = F.col("month_start") == F.col("m")
    prev = Window.orderBy("month_start")
    prev_is_adjacent = F.lag("month_start").over(prev) == F.add_months("month_start", -1)
    return spread.select(
        "month_start",
        F.when(prev_is_adjacent, F.lag("n").over(prev)).otherwise(0).cast("long")
         .alias("active_subscriptions_start"),
        F.coalesce(F.when(prev_is_adjacent, F.lag(F.when(F.col("v") > 0, F.col("p"))).over(prev)),
                   F.lit(0)).cast(MONEY_SUM).alias("mrr_start"),
        F.when(first, F.coalesce("c_n", F.lit(0))).otherwise(0).cast("long").alias("churned_subscriptions"),
        F.when(first & (F.col("c_v") > 0), F.col("c_p")).otherwise(0).cast(MONEY_SUM).alias("churned_mrr"))


def churn_rates(base: DataFrame) -> DataFrame:
    """Count- and revenue-weighted churn, 4 decimals, NULL when the base is 0."""
    return base.select(
        "month_start", "active_subscriptions_start", "churned_subscriptions",
        round_ratio(F.col("churned_subscriptions"), F.col("active_subscriptions_start"))
        .alias("subscription_churn_rate"),
        "mrr_start", "churned_mrr",
        round_ratio(F.col("churned_mrr"), F.col("mrr_start"), 4, 2, 2).alias("mrr_churn_rate"))


def customer_revenue(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Per customer with invoice activity: distinct subscriptions, invoices
    and EUR totals by status.  Invoices of unknown subscriptions drop out at
    the inner join; an orphan *customer* id still gets its own row here."""
    roll = invoice_rollup(invoices).drop("last_invoice_date")
    subs = subscriptions.select("subscription_id", "customer_id")
    return (roll.join(subs, "subscription_id", "inner")
            .groupBy("customer_id")
            .agg(F.count("subscription_id").alias("subscription_count"),
                 F.sum("invoice_count").cast("long").alias("invoice_count"),
                 F.sum("total_paid_eur").cast(MONEY_SUM).alias("total_paid_eur"),
                 F.sum("total_open_eur").cast(MONEY_SUM).alias("total_open_eur"),
                 F.sum("total_failed_eur").cast(MONEY_SUM).alias("total_failed_eur")))


def subscription_summary(subscriptions: DataFrame) -> DataFrame:
    """Per customer (valid-customer subscriptions only): every distinct plan
    ever held, sorted and comma-joined, and the status of the most recent
    subscription (latest start — a NULL start counts as most recent, as in
    a descending sort with NULLs first — then highest id).

    One aggregate, no window: the "top row" is a ``max_by`` over a sort key,
    and the plan set is a ``collect_set`` bounded by the number of plans, so
    a customer with millions of subscriptions is combined map-side.
    """
    recency = F.struct(F.col("start_date").isNull(), F.col("start_date"),
                       F.col("subscription_id").isNull(), F.col("subscription_id"))
    plans = F.array_sort(F.collect_set("plan_name"))
    return (subscriptions.where(F.col("has_valid_customer"))
            .groupBy("customer_id")
            .agg(F.when(F.size(plans) > 0, F.array_join(plans, ", ")).alias("plan_mix"),
                 F.max_by("status", recency).alias("current_subscription_status")))


def customer_rollup(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Revenue and plan summary per customer in one aggregate: subscriptions
    left-joined to their invoice rollup, grouped once by customer_id.

    Equals ``customer_revenue`` ⟗ ``subscription_summary`` on the columns
    the LTV mart reads (for customers that exist): the revenue columns use
    only subscriptions that have invoices, the summary only valid-customer
    subscriptions.  Reading subscriptions once instead of twice removes a
    full subscription pipeline from the LTV plan.
    """
    roll = invoice_rollup(invoices).drop("last_invoice_date").withColumn("_has_inv", F.lit(True))
    valid = F.col("has_valid_customer")
    recency = F.struct(F.col("start_date").isNull(), F.col("start_date"),
                       F.col("subscription_id").isNull(), F.col("subscription_id"))
    plans = F.array_sort(F.collect_set(F.when(valid, F.col("plan_name"))))
    return (subscriptions.join(roll, "subscription_id", "left")
            .groupBy("customer_id")
            .agg(F.count_if(F.col("_has_inv").isNotNull() & F.col("subscription_id").isNotNull())
                  .alias("subscription_count"),
                 F.sum("total_paid_eur").cast(MONEY_SUM).alias("total_paid_eur"),
                 F.sum("total_open_eur").cast(MONEY_SUM).alias("total_open_eur"),
                 F.sum("total_failed_eur").cast(MONEY_SUM).alias("total_failed_eur"),
                 F.when(F.size(plans) > 0, F.array_join(plans, ", ")).alias("plan_mix"),
                 F.max_by(F.when(valid, F.col("status")), F.when(valid, recency))
                  .alias("current_subscription_status")))


def customer_ltv(customers: DataFrame, rollup: DataFrame) -> DataFrame:
    """Every clean customer with realised revenue (paid), pending (open) and
    failed EUR, subscription count, plan mix and current status.  Money and
    counts default to 0; plan mix and status stay NULL without subscriptions."""
    zero = F.lit(0).cast(MONEY_SUM)
    return (customers.select("customer_id", "customer_name", "country")
            .join(rollup, "customer_id", "left")
            .select("customer_id", "customer_name", "country", "plan_mix",
                    "current_subscription_status",
                    F.coalesce("subscription_count", F.lit(0)).cast("long").alias("subscription_count"),
                    F.coalesce("total_paid_eur", zero).alias("ltv"),
                    F.coalesce("total_open_eur", zero).alias("pending_revenue_eur"),
                    F.coalesce("total_failed_eur", zero).alias("failed_revenue_eur")))
