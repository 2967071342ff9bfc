"""The billing project's check suite (generic column checks + singular checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators.quality import Check

# Accepted domains of the cleaned models.
SUBSCRIPTION_STATUSES = ("active", "cancelled", "paused")
INVOICE_STATUSES = ("paid", "failed", "open")
CURRENCIES = ("EUR", "SEK")
PLANS = ("starter", "growth", "scale")

W = "warn"


def column_checks() -> list[Check]:
    """The 39 generic checks: 21 staging, 8 intermediate, 10 marts."""
    return [
        # staging: customers
        Check("unique", "stg_customers", "customer_id"),
        Check("not_null", "stg_customers", "customer_id"),
        Check("not_null", "stg_customers", "customer_name"),
        Check("not_future_date", "stg_customers", "created_at", W),
        # staging: subscriptions
        Check("unique", "stg_subscriptions", "subscription_id"),
        Check("not_null", "stg_subscriptions", "subscription_id"),
        Check("not_null", "stg_subscriptions", "customer_id"),
        Check("relationships", "stg_subscriptions", "customer_id", W,
              to_model="stg_customers", to_field="customer_id"),
        Check("not_null", "stg_subscriptions", "monthly_price"),
        Check("flag_equals", "stg_subscriptions", "had_negative_price_defect", W, values=(False,)),
        Check("flag_equals", "stg_subscriptions", "has_valid_customer", W, values=(True,)),
        Check("accepted_values", "stg_subscriptions", "status", values=SUBSCRIPTION_STATUSES),
        # staging: invoices
        Check("unique", "stg_invoices", "invoice_id"),
        Check("not_null", "stg_invoices", "invoice_id"),
        Check("not_null", "stg_invoices", "subscription_id"),
        Check("relationships", "stg_invoices", "subscription_id", W,
              to_model="stg_subscriptions", to_field="subscription_id"),
        Check("flag_equals", "stg_invoices", "had_missing_amount_defect", W, values=(False,)),
        Check("flag_equals", "stg_invoices", "had_negative_amount_defect", W, values=(False,)),
        Check("flag_equals", "stg_invoices", "has_valid_subscription", W, values=(True,)),
        Check("accepted_values", "stg_invoices", "status", values=INVOICE_STATUSES),
        Check("accepted_values", "stg_invoices", "currency", values=CURRENCIES),
        # intermediate
        Check("unique", "effective_dates", "subscription_id"),
        Check("not_null", "effective_dates", "subscription_id"),
        Check("not_null", "subscription_months", "month_start"),
        Check("unique", "customer_revenue", "customer_id"),
        Check("unique", "churn_base", "month_start"),
        Check("unique", "subscription_summary", "customer_id"),
        Check("not_null", "subscription_summary", "customer_id"),
        Check("accepted_values", "subscription_summary", "current_subscription_status",
              values=SUBSCRIPTION_STATUSES),
        # marts
        Check("not_null", "mrr_by_month_plan", "month_start"),
        Check("not_null", "mrr_by_month_plan", "plan_name"),
        Check("accepted_values", "mrr_by_month_plan", "plan_name", values=PLANS),
        Check("not_null", "mrr_by_month_plan", "mrr"),
        Check("unique", "customer_ltv", "customer_id"),
        Check("not_null", "customer_ltv", "customer_id"),
        Check("accepted_values", "customer_ltv", "current_subscription_status", W,
              values=SUBSCRIPTION_STATUSES),
        Check("not_null", "customer_ltv", "ltv"),
        Check("unique", "churn_rates", "month_start"),
        Check("not_null", "churn_rates", "month_start"),
    ]


def _invoices_after_end(resolve):
    inv = resolve("stg_invoices").select("subscription_id", "invoice_date")
    subs = resolve("stg_subscriptions").select("subscription_id", "end_date")
    return (inv.join(subs, "subscription_id", "inner")
            .where(F.col("end_date").isNotNull() & (F.col("invoice_date") > F.col("end_date"))))


def singular_checks() -> list[Check]:
    """The 8 project-specific checks."""
    return [
        Check("expression", "stg_subscriptions", name="subscription_starts_before_it_ends",
              predicate="end_date IS NOT NULL AND end_date < start_date"),
        Check("expression", "effective_dates", name="active_window_starts_before_it_ends",
              predicate="effective_end_date IS NOT NULL AND effective_end_date < start_date"),
        Check("rows", "stg_invoices", name="billing_stops_with_the_subscription",
              rows=_invoices_after_end),
        Check("expression", "mrr_by_month_plan", name="mrr_is_zero_or_more", predicate="mrr < 0"),
        Check("expression", "customer_ltv", name="ltv_is_zero_or_more", predicate="ltv < 0"),
        Check("expression", "churn_rates", name="churn_rates_are_shares",
              predicate="subscription_churn_rate < 0 OR subscription_churn_rate > 1 "
                        "OR mrr_churn_rate < 0 OR mrr_churn_rate > 1"),
        Check("row_count_matches", "stg_customers", name="each_raw_customer_is_cleaned_once",
              to_model="raw_customers", to_field="customer_id"),
        Check("expression", "effective_dates", severity=W,
              name="cancelled_windows_are_closed",
              predicate="status = 'cancelled' AND effective_end_date IS NULL"),
    ]


def landing_checks() -> list[Check]:
    """Contract of the raw layer: the surrogate row id is unique per table
    (the staging dedup orders by it alone)."""
    return [Check("unique", f"raw_{t}", "_row_id", name=f"unique_raw_{t}_row_id")
            for t in ("customers", "subscriptions", "invoices")]
