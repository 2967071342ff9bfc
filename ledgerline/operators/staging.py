"""Staging jobs: raw text → typed, cleaned models with visible defect flags.

Corrections never hide: a negative amount is made positive *and* flagged,
an orphan is kept *and* flagged, a blank stays NULL *and* flagged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    MONEY,
    blank_to_null,
    flag,
    normalise_code,
    to_date_or_null,
    to_decimal_or_null,
)
from ledgerline.functions.fx import FIXED_EUR_RATES, convert_to_eur
from ledgerline.operators.dedup import keep_first
from ledgerline.operators.existence import existence_flag
from ledgerline.sources.raw import RAW_KEY

CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "country", "created_at"]
SUBSCRIPTION_COLUMNS = ["subscription_id", "customer_id", "plan_name", "monthly_price",
                        "had_negative_price_defect", "start_date", "end_date", "status",
                        "has_valid_customer", "updated_at"]
INVOICE_COLUMNS = ["invoice_id", "subscription_id", "invoice_date", "amount", "currency",
                   "amount_eur", "status", "had_missing_amount_defect",
                   "had_negative_amount_defect", "has_valid_subscription", "updated_at"]


def _dedup_order(df: DataFrame, row_id: str = "_row_id"):
    # Lowest surrogate id wins.  The surrogate is unique by contract (landing
    # assigns it), so it alone is a total order; ordering by nothing else lets
    # Catalyst prune every column a consumer does not read through the window.
    return [F.col(row_id).asc_nulls_last()]


def clean_customers(raw: DataFrame) -> DataFrame:
    """One row per customer_id (lowest row id); blank country → NULL;
    created_at typed (unparseable → NULL); a future date is kept for the
    ``not_future_date`` check to report."""
    typed = raw.select(
        "_row_id", "customer_id", "customer_name", "email",
        blank_to_null("country").alias("country"),
        to_date_or_null("created_at").alias("created_at"))
    return keep_first(typed, "customer_id", _dedup_order(typed)).select(*CUSTOMER_COLUMNS)


def _typed_subscriptions(raw: DataFrame) -> DataFrame:
    price = to_decimal_or_null("monthly_price", MONEY)
    start = to_date_or_null("start_date")
    end_raw = to_date_or_null("end_date")
    return raw.select(
        "_row_id", "subscription_id", "customer_id", "plan_name",
        F.abs(price).alias("monthly_price"),
        flag(price < 0).alias("had_negative_price_defect"),
        start.alias("start_date"),
        F.when(end_raw < start, F.lit(None).cast("date")).otherwise(end_raw).alias("end_date"),
        normalise_code("status").alias("status"),
        F.col("updated_at").cast("timestamp").alias("updated_at"))


def dedup_subscriptions(raw: DataFrame) -> DataFrame:
    """Typed, corrected and de-duplicated subscriptions *without* the
    customer existence flag — what the activity, MRR and churn models read.
    Output is hash-partitioned on subscription_id (the dedup shuffle), which
    the effective-dates join reuses."""
    typed = _typed_subscriptions(raw)
    cols = [c for c in SUBSCRIPTION_COLUMNS if c != "has_valid_customer"]
    return keep_first(typed, "subscription_id", _dedup_order(typed)).select(*cols)


def clean_subscriptions(raw: DataFrame, raw_customers: DataFrame) -> DataFrame:
    """One row per subscription_id (lowest row id).

    * price: typed, ``abs()``-corrected, ``had_negative_price_defect`` set;
    * an end date before the start date is set to NULL (start untouched);
    * status lower-cased and trimmed;
    * ``has_valid_customer`` = the customer id exists in the *raw* customers.
    """
    flagged = existence_flag(dedup_subscriptions(raw), "customer_id", raw_customers, "customer_id",
                             "has_valid_customer")
    return flagged.select(*SUBSCRIPTION_COLUMNS)


def type_invoices(raw: DataFrame, rates=FIXED_EUR_RATES) -> DataFrame:
    """Row-wise part of invoice cleaning (no dedup, no existence flag), so an
    incremental load can apply it to a batch alone.  The landed row id, where
    there is one, is carried as the key of such a load."""
    amount_raw = to_decimal_or_null("amount", MONEY)
    return raw.select(
        "invoice_id", "subscription_id",
        to_date_or_null("invoice_date").alias("invoice_date"),
        F.abs(amount_raw).alias("amount"),
        F.col("currency"),
        convert_to_eur(F.abs(amount_raw), F.col("currency"), rates).alias("amount_eur"),
        normalise_code("status").alias("status"),
        amount_raw.isNull().alias("had_missing_amount_defect"),
        flag(amount_raw < 0).alias("had_negative_amount_defect"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        *[c for c in raw.columns if c == RAW_KEY])


def clean_invoices(raw: DataFrame, raw_subscriptions: DataFrame, rates=FIXED_EUR_RATES) -> DataFrame:
    """Every invoice row (no dedup): amount ``abs()`` + flag, blank amount
    stays NULL + flag, EUR conversion, status normalised, orphan kept +
    ``has_valid_subscription`` flag against the raw subscriptions."""
    return flag_invoices(type_invoices(raw, rates), raw_subscriptions)


def flag_invoices(typed: DataFrame, raw_subscriptions: DataFrame) -> DataFrame:
    """The subscription flag over typed invoices, however they were kept."""
    flagged = existence_flag(typed, "subscription_id", raw_subscriptions, "subscription_id",
                             "has_valid_subscription")
    return flagged.select(*INVOICE_COLUMNS)
