"""One test per semantic trap of the billing models (hand-written rows)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.plans.models import BillingModels
from tests.fixtures import AS_OF, billing_raw

D = dt.date


def models(spark, customers, subscriptions, invoices, as_of=AS_OF):
    return BillingModels(billing_raw(spark, customers, subscriptions, invoices), as_of)


CUSTOMERS = [
    (1, "C1", "Ann", "a@x", "SE", "2023-01-01"),
    (2, "C2", "Bob", "b@x", "", "2023-02-01"),          # blank country
    (3, "C3", "Cid", "c@x", "DE", ""),                  # blank created_at
    (4, "C1", "Ann", "a@x", "SE", "2023-01-01"),        # exact duplicate, higher id
    (5, "C4", "Dee", "d@x", "FI", "2030-01-01"),        # future created_at
    (6, "C5", "Eve", "e@x", "NO", "2023-03-01"),        # no subscriptions
]


def test_customers_dedup_blank_and_future(spark):
    m = models(spark, CUSTOMERS, [], [])
    rows = {r.customer_id: r for r in m.stg_customers.collect()}
    assert len(rows) == 5
    assert rows["C2"].country is None
    assert rows["C3"].created_at is None              # N3: no failure, NULL
    assert rows["C4"].created_at == D(2030, 1, 1)     # kept for the check to report


SUBS = [
    # id, customer, plan, price, start, end, status
    ("S1", "C1", "starter", "29.00", "2024-01-10", "", "active"),
    ("S2", "C1", "growth", "-99.00", "2024-02-01", "2024-01-15", "cancelled"),  # neg price, end<start
    ("S3", "C9", "scale", "299.00", "2024-03-05", "", "ACTIVE "),               # orphan, casing
    ("S4", "C2", "starter", "", "2024-01-01", "2024-03-01", "cancelled"),      # blank price, end on 1st
    ("S5", "C2", "growth", "99.00", "2024-04-03", "2024-04-20", "cancelled"),  # start+end same month
    ("S6", "C3", "scale", "299.00", "2024-09-01", "", "active"),              # future start
    ("S7", "C3", "starter", "29.00", "", "", "paused"),                       # null start
    ("S8", "C4", "growth", "99.00", "2024-01-20", "2024-01-20", "cancelled"),  # start = end
    ("S9", "C4", "scale", "299.00", "2024-02-02", "", "cancelled"),           # cancelled, no end, no invoice
    ("S1", "C1", "starter", "29.00", "2024-01-10", "", "active"),              # exact duplicate
    ("S10", "C1", "starter", "29.00", "2024-05-01", "", "\tpaused"),           # tab survives trim
]
INVOICES = [
    ("I1", "S1", "2024-01-10", "29.00", "EUR", "paid"),
    ("I2", "S2", "2024-03-01", "99.00", "SEK", "PAID "),
    ("I3", "S2", "2024-04-01", "-99.00", "EUR", "failed"),
    ("I4", "S3", "2024-03-05", "299.00", " EUR", "paid"),     # ' EUR' → NULL
    ("I5", "S3", "2024-04-05", "299.00", "USD", "open"),      # USD → NULL
    ("I6", "S99", "2024-04-05", "10.00", "EUR", "paid"),      # orphan subscription
    ("I7", "S4", "2024-02-01", "", "EUR", "paid"),            # blank amount
    ("I8", "S5", "2024-04-03", "99.00", "EUR", "paid"),
    ("I1", "S1", "2024-01-10", "29.00", "EUR", "paid"),       # duplicate id: kept (no dedup)
]


def full(spark, as_of=AS_OF):
    return models(spark, CUSTOMERS, SUBS, INVOICES, as_of)


def test_subscription_cleaning(spark):
    m = full(spark)
    s = {r.subscription_id: r for r in m.stg_subscriptions.collect()}
    assert len(s) == 10
    assert s["S2"].monthly_price == Decimal("99.00") and s["S2"].had_negative_price_defect
    assert s["S2"].end_date is None and s["S2"].start_date == D(2024, 2, 1)
    assert s["S3"].status == "active" and not s["S3"].has_valid_customer
    assert s["S4"].monthly_price is None and s["S4"].had_negative_price_defect is False  # N4
    assert s["S8"].end_date == D(2024, 1, 20)                                           # N21
    assert s["S10"].status == "\tpaused"                                                # FN-2


def test_invoice_cleaning(spark):
    m = full(spark)
    rows = m.stg_invoices.collect()
    assert len(rows) == 9                                                   # N15 parity: no dedup
    i = {r.invoice_id: r for r in rows}
    assert i["I2"].amount_eur == Decimal("8.71") and i["I2"].status == "paid"   # 99*0.088=8.712
    assert i["I3"].amount == Decimal("99.00") and i["I3"].had_negative_amount_defect
    assert i["I4"].amount_eur is None and i["I5"].amount_eur is None         # N16
    assert not i["I6"].has_valid_subscription
    assert i["I7"].amount is None and i["I7"].had_missing_amount_defect
    assert i["I7"].had_negative_amount_defect is False


def test_effective_dates(spark):
    e = {r.subscription_id: r for r in full(spark).effective_dates.collect()}
    assert e["S2"].effective_end_date == D(2024, 4, 1) and e["S2"].effective_end_date_is_inferred
    assert e["S9"].effective_end_date is None and e["S9"].effective_end_date_is_inferred   # N14
    assert e["S1"].effective_end_date_is_inferred is False


def test_monthly_grain(spark):
    months = {}
    for r in full(spark).subscription_months.collect():
        months.setdefault(r.subscription_id, []).append(r.month_start)
    assert D(2024, 3, 1) in months["S4"]                    # end on the 1st counts that month
    assert max(months["S4"]) == D(2024, 3, 1)
    assert "S6" not in months and "S7" not in months        # future and NULL starts
    assert months["S5"] == [D(2024, 4, 1)]
    assert max(months["S9"]) == D(2024, 6, 1)               # N14: active through as_of
    assert months["S8"] == [D(2024, 1, 1)]


def test_mrr_forms_agree(spark):
    m = full(spark)
    a = sorted(map(tuple, m.mrr_by_month_plan.collect()), key=str)
    b = sorted(map(tuple, m.mrr_running_sum.collect()), key=str)
    assert a == b
    # the blank-price subscription counts but adds nothing
    jan = {r.plan_name: r for r in m.mrr_by_month_plan.where("month_start = '2024-01-01'").collect()}
    assert jan["starter"].active_subscriptions == 2 and jan["starter"].mrr == Decimal("29.00")


def test_all_null_price_group_gives_null_mrr(spark):
    subs = [("S1", "C1", "starter", "", "2024-01-10", "", "active")]
    m = models(spark, CUSTOMERS, subs, [])
    a = m.mrr_by_month_plan.collect()
    b = m.mrr_running_sum.collect()
    assert all(r.mrr is None for r in a) and sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_churn(spark):
    c = {r.month_start: r for r in full(spark).churn_rates.collect()}
    first = min(c)
    assert c[first].active_subscriptions_start == 0 and c[first].subscription_churn_rate is None  # N12
    apr = c[D(2024, 4, 1)]
    assert apr.churned_subscriptions >= 2     # S2 (inferred end 2024-04-01) and S5 (N11)
    base = full(spark).mrr_by_month_plan.groupBy("month_start").agg(F.sum("active_subscriptions").alias("n"))
    n = {r.month_start: r.n for r in base.collect()}
    for month, row in c.items():
        prev = D(month.year - (month.month == 1), 12 if month.month == 1 else month.month - 1, 1)
        assert row.active_subscriptions_start == n.get(prev, 0)


def test_gap_month_vanishes(spark):
    subs = [("S1", "C1", "starter", "10.00", "2024-01-05", "2024-01-20", "cancelled"),
            ("S2", "C1", "starter", "10.00", "2024-03-05", "", "active")]
    months = {r.month_start for r in models(spark, CUSTOMERS, subs, []).churn_base.collect()}
    assert D(2024, 2, 1) not in months and D(2024, 1, 1) in months and D(2024, 3, 1) in months


def test_revenue_summary_ltv(spark):
    m = full(spark)
    rev = {r.customer_id: r for r in m.customer_revenue.collect()}
    assert "C9" in rev                                        # N1: orphan customer survives here
    assert rev["C1"].invoice_count == 4 and rev["C1"].subscription_count == 2
    assert rev["C2"].total_paid_eur == Decimal("99.00")       # I7's NULL amount is skipped
    ltv = {r.customer_id: r for r in m.customer_ltv.collect()}
    assert "C9" not in ltv
    assert ltv["C5"].plan_mix is None and ltv["C5"].subscription_count == 0 and ltv["C5"].ltv == 0
    summ = {r.customer_id: r for r in m.subscription_summary.collect()}
    assert summ["C3"].current_subscription_status == "paused"  # N2: NULL start ranks first
    assert summ["C1"].plan_mix == "growth, starter"


def test_all_null_paid_group(spark):
    invs = [("I1", "S4", "2024-02-01", "", "EUR", "paid")]
    m = models(spark, CUSTOMERS, SUBS, invs)
    rev = {r.customer_id: r for r in m.customer_revenue.collect()}
    assert rev["C2"].total_paid_eur is None
    ltv = {r.customer_id: r for r in m.customer_ltv.collect()}
    assert ltv["C2"].ltv == 0


def test_empty_dataset(spark):
    m = models(spark, [], [], [])
    assert m.subscription_months.count() == 0
    assert m.mrr_running_sum.count() == 0
    assert m.churn_rates.count() == 0
    assert m.customer_ltv.count() == 0


def test_ltv_parts_sum_to_total(spark):
    m = full(spark)
    inv = m.stg_invoices.join(m.stg_subscriptions.select("subscription_id", "customer_id"), "subscription_id")
    tot = {r.customer_id: r.t for r in inv.where(F.col("status").isin("paid", "open", "failed"))
           .groupBy("customer_id").agg(F.sum("amount_eur").alias("t")).collect()}
    for r in m.customer_ltv.collect():
        if r.customer_id in tot:
            assert r.ltv + r.pending_revenue_eur + r.failed_revenue_eur == (tot[r.customer_id] or 0)


def test_churn_ignores_events_after_as_of(spark):
    subs = [("S1", "C1", "starter", "10.00", "2024-01-05", "", "active"),
            ("S2", "C1", "starter", "", "2024-02-05", "2024-03-10", "cancelled"),
            ("S3", "C1", "growth", "20.00", "2024-01-05", "2024-09-10", "cancelled")]
    m = models(spark, CUSTOMERS, subs, [], as_of=dt.date(2024, 5, 20))
    c = {r.month_start: r for r in m.churn_base.collect()}
    assert max(c) == D(2024, 5, 1) and min(c) == D(2024, 1, 1)
    assert c[D(2024, 3, 1)].churned_subscriptions == 1 and c[D(2024, 3, 1)].churned_mrr == 0
    assert c[D(2024, 4, 1)].active_subscriptions_start == 3
    assert c[D(2024, 4, 1)].mrr_start == Decimal("30.00")
