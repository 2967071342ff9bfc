"""Marts kept up to date by a load's deltas instead of a rebuild.

MRR by month and plan is a sum over subscriptions, so a load changes it by what its
subscriptions contribute now less what they contributed before.  Stored are the
month-to-month differences (``metrics.mrr_deltas``: plans × months rows); a refresh reads the rows of the
touched subscriptions before and after the load and adds the difference.
Whatever the load did - a price, a plan, an earlier end, a later bill, a row that moves to another
subscription - the sum stays that of a full refresh.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import MONEY_SUM
from ledgerline.operators.metrics import mrr_deltas
from ledgerline.operators.periods import effective_dates
from ledgerline.operators.staging import dedup_subscriptions, type_invoices
from ledgerline.sources.raw import RAW_KEY

TABLES = ("subscriptions", "invoices")
DELTAS = ("dr", "dn", "dp", "dv")


def touched_subscriptions(before: dict[str, DataFrame], batch: dict[str, DataFrame]) -> DataFrame:
    """The subscriptions a load can change: those of its rows, and those its rows
    belonged to before.  A NULL id is one subscription, as in staging."""
    ids = [batch[t].select("subscription_id") for t in TABLES]
    ids += [before[t].join(batch[t].select(RAW_KEY).distinct(), RAW_KEY, "left_semi").select("subscription_id") for t in TABLES]
    return reduce(DataFrame.unionByName, ids).distinct()


def mrr_contribution(raw: dict[str, DataFrame], touched: DataFrame | None = None) -> DataFrame:
    """The MRR deltas of the touched subscriptions (all without ``touched``).

    Rows are cut to the touched subscriptions before anything is shuffled where that
    set is small enough for AQE to broadcast.  Bills without a subscription belong to none.
    """
    subs, bills = raw["subscriptions"], raw["invoices"].where(F.col("subscription_id").isNotNull())
    if touched is not None:
        own = touched.select(F.col("subscription_id").alias("_touched"))
        subs = subs.join(own, F.col("subscription_id").eqNullSafe(F.col("_touched")), "left_semi")
        bills = bills.join(own, F.col("subscription_id") == F.col("_touched"), "left_semi")
    deltas = mrr_deltas(effective_dates(dedup_subscriptions(subs), type_invoices(bills)))
    return deltas.select("plan_name", "m", *[F.col(c).cast(MONEY_SUM if c == "dp" else "long").alias(c) for c in DELTAS])


def refreshed_mrr(totals: DataFrame, before: dict[str, DataFrame], after: dict[str, DataFrame],
                  touched: DataFrame) -> DataFrame:
    """``totals`` (plan_name, m, dr, dn, dp, dv) after a load; read with ``metrics.mrr_levels``.
    ``touched`` is best a stored table: it is read four times."""
    was = mrr_contribution(before, touched).select("plan_name", "m", *[(-F.col(c)).alias(c) for c in DELTAS])
    parts = totals.unionByName(mrr_contribution(after, touched)).unionByName(was)
    out = parts.groupBy("plan_name", "m").agg(*[F.sum(c).cast(MONEY_SUM if c == "dp" else "long").alias(c) for c in DELTAS])
    return out.where(" OR ".join(f"coalesce({c}, 0) <> 0" for c in DELTAS))
