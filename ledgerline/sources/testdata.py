"""Raw billing tables derived from the driver's TPC-H-style test data.

The formulas plant known defects at fixed rates (blank values, duplicates,
negative money, orphans, reversed dates, bad casing, foreign currency) so the
cleaning and checking jobs have something to find.  ``k`` is each source
table's integer key.  All business columns come out as text, exactly like a
raw landing table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.raw import add_updated_at

# Fixed as-of date for every query over the test data (the data ends 2001-08).
TEST_AS_OF = _dt.date(2001, 8, 31)


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table.  The schema is inferred once per path and then
    passed explicitly (inference launches a footer-reading job per read)."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def landed_ids(k: F.Column, every: int) -> F.Column:
    """Row ids under which key ``k`` lands: [2k], and 2k + 1 too (a planted exact
    copy) for every ``every``-th key, so no copy can meet another key's id.
    Exploding this array makes the copies in the same scan (a union would
    read the source twice)."""
    first = (k * 2).cast("long")
    return F.when(k % every == 0, F.array(first, first + 1)).otherwise(F.array(first))


def _day_text(base: F.Column, days: F.Column) -> F.Column:
    return F.date_add(base, days.cast("int")).cast("string")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⟕ nation → raw customers; every 50th key is landed twice."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    landed = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
              .select(F.explode(landed_ids(k, 50)).alias("_row_id"), "*"))
    out = landed.select(
        "_row_id",
        F.concat(F.lit("C"), k.cast("string")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(k % 37 == 0, F.lit("")).otherwise(F.col("n_name")).alias("country"),
        F.when(k % 499 == 0, F.lit("2031-01-01"))
         .otherwise(_day_text(F.lit(_dt.date(1995, 1, 1)), k % 2000)).alias("created_at"))
    return add_updated_at(out, "created_at")


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → raw subscriptions; every 101st key is landed twice."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    status = (F.when(F.col("o_orderstatus") == "F", "cancelled")
              .when(F.col("o_orderstatus") == "P", "paused")
              .when(F.col("o_orderstatus") == "O", "active"))
    end_date = (F.when((F.col("o_orderstatus") != "F") | (k % 83 == 0), F.lit(""))
                .when(k % 89 == 0, F.date_sub(start, 10).cast("string"))
                .otherwise(_day_text(start, F.lit(30) + k % 700)))
    out = o.select(F.explode(landed_ids(k, 101)).alias("_row_id"), "*").select(
        "_row_id",
        F.concat(F.lit("S"), k.cast("string")).alias("subscription_id"),
        F.when(k % 211 == 0, F.lit("C-orphan"))
         .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("customer_id"),
        F.col("o_orderpriority").alias("plan_name"),
        F.when(k % 97 == 0, -price).otherwise(price).cast("string").alias("monthly_price"),
        start.cast("string").alias("start_date"),
        end_date.alias("end_date"),
        F.when(k % 71 == 0, F.concat(F.upper(status), F.lit(" "))).otherwise(status).alias("status"))
    return add_updated_at(out, "start_date")


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per (order, line number) of lineitem, dated off the order."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # The flags are single characters, so max() over their code points equals
    # max() over the strings and keeps the aggregate hash-based (a string
    # max would force a sort-based aggregate).
    # Dealt by order once: the sums and the join both take it as it lies, and
    # no table of partial sums, as long as the input, is built before the shuffle.
    lines = (li.where(F.col("l_orderkey").isNotNull()).repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber")
             .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amt"),
                  F.max(F.ascii("l_returnflag")).alias("rf"),
                  F.max(F.ascii("l_linestatus")).alias("ls")))
    k = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    amt = F.col("amt")
    joined = lines.join(o, lines.l_orderkey == o.o_orderkey, "inner")
    return add_updated_at(joined.select(
        (k * 100 + ln).alias("_row_id"),
        F.concat(F.lit("I"), k.cast("string"), F.lit("-"), ln.cast("string")).alias("invoice_id"),
        F.when(k % 601 == 0, F.lit("S-orphan"))
         .otherwise(F.concat(F.lit("S"), k.cast("string"))).alias("subscription_id"),
        _day_text(F.col("o_orderdate").cast("date"), (ln - 1) * 30).alias("invoice_date"),
        F.when((k * 7 + ln) % 503 == 0, F.lit(""))
         .otherwise(F.when(k % 97 == 0, -amt).otherwise(amt).cast("string")).alias("amount"),
        F.when(k % 613 == 0, F.lit("USD"))
         .when((F.col("rf") == ord("R")) & (k % 5 == 0), F.lit("SEK"))
         .otherwise(F.lit("EUR")).alias("currency"),
        F.when(F.col("ls") == ord("F"), F.when(k % 67 == 0, F.lit("PAID ")).otherwise(F.lit("paid")))
         .when(F.col("rf") == ord("A"), F.lit("failed"))
         .otherwise(F.lit("open")).alias("status"),
    ), "invoice_date")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"customers": raw_customers(spark, sf_dir),
            "subscriptions": raw_subscriptions(spark, sf_dir),
            "invoices": raw_invoices(spark, sf_dir)}
