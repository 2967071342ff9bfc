"""The planted-defect counts documented for the sf0.01 test data (FIXTURES §3)."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def m(spark):
    from ledgerline.plans.queries import models
    return models(spark, SF)


def test_customers(m):
    raw = m.raw["customers"]
    assert raw.count() == 1530 and m.stg_customers.count() == 1500
    assert m.stg_customers.where(F.col("country").isNull()).count() == 41
    assert m.stg_customers.where(F.col("created_at") > F.lit(m.as_of)).count() == 4


def test_subscriptions(m):
    assert m.raw["subscriptions"].count() == 15149
    s = m.stg_subscriptions
    assert s.count() == 15000
    counts = s.agg(F.count_if("had_negative_price_defect").alias("neg"),
                   F.count_if(~F.col("has_valid_customer")).alias("orphan")).first()
    assert (counts.neg, counts.orphan) == (155, 72)
    raw = m.raw["subscriptions"].where(F.col("_row_id") % 2 == 0)
    assert raw.where(F.col("end_date") != "").where(
        F.col("end_date").cast("date") < F.col("start_date").cast("date")).count() == 67
    assert raw.where(F.col("status") != F.lower(F.trim("status"))).count() == 212
    assert raw.where((F.lower(F.trim("status")) == "cancelled") & (F.col("end_date") == "")).count() == 66


def test_effective_dates(m):
    e = m.effective_dates
    cancelled = e.where(F.col("status") == "cancelled")
    assert cancelled.where(F.col("end_date").isNull()).count() == 133
    assert cancelled.where(F.col("effective_end_date").isNull()).count() == 2
    assert e.where(F.col("effective_end_date") < F.col("start_date")).count() == 0


def test_invoices(m):
    i = m.stg_invoices
    c = i.agg(F.count(F.lit(1)).alias("n"), F.count_if("had_missing_amount_defect").alias("blank"),
              F.count_if("had_negative_amount_defect").alias("neg"),
              F.count_if(~F.col("has_valid_subscription")).alias("orphan")).first()
    assert (c.n, c.blank, c.neg, c.orphan) == (45832, 89, 446, 84)
    assert m.raw["invoices"].where(F.col("status") == "PAID ").count() == 273
    assert {r.currency: r["count"] for r in i.groupBy("currency").count().collect()} == \
        {"EUR": 42031, "SEK": 3716, "USD": 85}
    assert {r.status: r["count"] for r in i.groupBy("status").count().collect()} == \
        {"failed": 6561, "open": 19654, "paid": 19617}


def test_grain_and_mrr(m):
    g = m.subscription_months
    assert g.count() == 472138
    assert g.select("month_start").distinct().count() == 80
    row = m.mrr_by_month_plan.where((F.col("month_start") == dt.date(2001, 8, 1)) &
                                    (F.col("plan_name") == "1-URGENT")).first()
    assert row.mrr == Decimal("544144230.30") and row.active_subscriptions == 2138


def test_check_counts(spark, m):
    from ledgerline.operators.quality import run_checks
    from ledgerline.plans.checks import singular_checks
    res = {r.check_name: r.failures for r in run_checks(spark, singular_checks(), m.model, m.as_of).collect()}
    assert res["billing_stops_with_the_subscription"] == 1393
    assert res["churn_rates_are_shares"] == 0
    assert res["cancelled_windows_are_closed"] == 2


def test_scd2_history_is_well_formed(spark):
    from pyspark.sql import Window

    from ledgerline.plans.queries import QUERIES
    h = QUERIES["scd2_history"](spark, SF)
    per_key = h.groupBy("user_id").agg(F.count_if(F.col("valid_to").isNull()).alias("current"))
    assert per_key.where(F.col("current") != 1).count() == 0          # one current version per key
    w = Window.partitionBy("user_id").orderBy("valid_from")
    gaps = (h.withColumn("next_from", F.lead("valid_from").over(w))
            .where(F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from"))))
    assert gaps.count() == 0                                            # contiguous, no overlap
    assert h.where(F.col("valid_to") <= F.col("valid_from")).count() == 0
