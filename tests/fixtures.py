"""Hand-written raw rows: one per semantic trap."""

from __future__ import annotations

import datetime as dt

from ledgerline.sources.raw import RAW_COLUMNS, land, raw_schema

AS_OF = dt.date(2024, 6, 15)


def raw_frame(spark, table, rows):
    """rows: list of tuples in RAW_COLUMNS order, optionally prefixed by _row_id."""
    cols = RAW_COLUMNS[table]
    if rows and len(rows[0]) == len(cols) + 1:
        df = spark.createDataFrame(rows, "_row_id long, " + ", ".join(f"{c} string" for c in cols))
    else:
        df = spark.createDataFrame(rows, raw_schema(table))
    return land(df, table)


def billing_raw(spark, customers, subscriptions, invoices):
    return {"customers": raw_frame(spark, "customers", customers),
            "subscriptions": raw_frame(spark, "subscriptions", subscriptions),
            "invoices": raw_frame(spark, "invoices", invoices)}
