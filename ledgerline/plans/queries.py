"""Registered queries over the driver's test data: name → (spark, sf_dir) → DataFrame.

Every query reads the given parquet tables (through the raw-table derivation
in ``sources.testdata``) and runs the library's operators over all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.models import BillingModels
from ledgerline.sources.testdata import TEST_AS_OF, raw_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str, materialize: bool = False) -> BillingModels:
    return BillingModels(raw_tables(spark, sf_dir), TEST_AS_OF, materialize=materialize)


def _model_query(name: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: models(spark, sf_dir).model(name)


for _name in ["stg_customers", "stg_subscriptions", "stg_invoices", "effective_dates",
              "subscription_months", "mrr_by_month_plan", "mrr_running_sum", "mrr_from_grain",
              "churn_base",
              "churn_rates", "customer_revenue", "subscription_summary", "customer_ltv"]:
    _model_query(_name)


# Models read by many checks and by other models: written once per run,
# independent ones concurrently.
SHARED_LEVELS = [["stg_customers", "stg_subscriptions", "stg_invoices"],
                 ["effective_dates", "customer_revenue", "subscription_summary", "customer_ltv"],
                 ["mrr_by_month_plan", "churn_base"], ["churn_rates"]]
SHARED_MODELS = {n for level in SHARED_LEVELS for n in level}


@query("dq_column_checks")
def dq_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.operators.quality import run_checks
    from ledgerline.plans.checks import column_checks
    m = models(spark, sf_dir, materialize=SHARED_MODELS)
    m.build(SHARED_LEVELS)
    return run_checks(spark, column_checks(), m.model, m.as_of)


@query("dq_singular_checks")
def dq_singular_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.operators.quality import run_checks
    from ledgerline.plans.checks import singular_checks
    m = models(spark, sf_dir, materialize=SHARED_MODELS)
    m.build(SHARED_LEVELS)
    return run_checks(spark, singular_checks(), m.model, m.as_of)


# ------------------------------------------------------------ incremental
# Fixed parameters of the two-run scenarios over the test data.
EVENTS_SPLIT = "2024-01-16 00:00:00"
INVOICE_FIRST_RUN_BEFORE = "1998-01-01 00:00:00"
SYNC_TIME = "2001-09-01 00:00:00"
QUARANTINE_RUNS = ("1998-01-01 00:00:00", "2000-01-01 00:00:00", SYNC_TIME)
SNAPSHOT_RUNS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")  # and one the day after the last event
STATE_FIRST_DAY = "2024-01-01"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    return (spark.read.parquet(f"{sf_dir}/events.parquet")
            .select("user_id", "event_id", "ts", "event_type", "value")
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")))


@query("upsert_two_batches")
def upsert_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state per user after two delete+insert loads of the event feed."""
    from pyspark.sql import functions as F
    from ledgerline.operators.incremental import upsert
    ev = _events(spark, sf_dir)
    split = F.lit(EVENTS_SPLIT).cast("timestamp_ntz")
    t1 = upsert(None, ev.where(F.col("ts") < split), "user_id", "ts", ["event_id"])
    return upsert(t1, ev.where(F.col("ts") >= split), "user_id", "ts", ["event_id"])


@query("partitioned_upsert")
def partitioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state per user through the stored layout: two loads of the event
    feed, where every seventh event has no day; a load rewrites the partitions
    of its users only."""
    from pyspark.sql import functions as F

    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.session import scratch_dir
    ev = _events(spark, sf_dir).withColumn("day", F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("date")))
    split = F.lit(EVENTS_SPLIT).cast("timestamp_ntz")
    table = ParquetTarget(spark, scratch_dir(spark, "partitioned-upsert"), "user_id", "ts")
    table.apply(ev.where(F.col("ts") < split), tiebreak=["event_id"])
    table.apply(ev.where(F.col("ts") >= split), tiebreak=["event_id"])
    return table.read().select("user_id", "event_id", "ts", "event_type", "value", "day")


def _landed_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw invoices as a stored table, for queries that read them several times."""
    from ledgerline.session import stored
    from ledgerline.sources.testdata import raw_invoices
    return stored(raw_invoices(spark, sf_dir), "raw-invoices")


def _invoice_loads(spark: SparkSession, sf_dir: str):
    from pyspark.sql import functions as F

    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.session import scratch_dir
    raw = _landed_invoices(spark, sf_dir)
    table = ParquetTarget(spark, scratch_dir(spark, "invoice-loads"), "_row_id", "updated_at")
    early = raw.where(F.col("updated_at") < F.lit(INVOICE_FIRST_RUN_BEFORE).cast("timestamp"))
    return table, [table.load(early, run_ts=SYNC_TIME), table.load(raw, run_ts=SYNC_TIME)]


@query("load_report")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the raw invoices: rows each run loaded, held back, and the
    rows of the table after it."""
    _, reports = _invoice_loads(spark, sf_dir)
    return spark.createDataFrame([(k + 1, r["loaded"], r["quarantined"], r["rows"]) for k, r in enumerate(reports)],
                                 "run long, loaded long, quarantined long, table_rows long")


@query("quarantine_rows")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoices whose cursor lies after the sync time, as kept aside by the load."""
    from pyspark.sql import functions as F
    from ledgerline.sources.testdata import raw_invoices
    table, _ = _invoice_loads(spark, sf_dir)
    held = table.quarantine()
    if held is None:
        held = raw_invoices(spark, sf_dir).where("false")
    return held.select("_row_id", "invoice_id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


@query("quarantine_lifecycle")
def quarantine_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw invoice that was ever ahead of a sync, one row each, after three
    runs: held, then released by the run that its time has come for; the last
    run clamps what is still ahead of it."""
    from pyspark.sql import functions as F
    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.session import scratch_dir
    raw = _landed_invoices(spark, sf_dir)
    table = ParquetTarget(spark, scratch_dir(spark, "quarantine"), "_row_id", "updated_at")
    for run_ts in QUARANTINE_RUNS:
        table.load(raw, run_ts=run_ts, clamp=run_ts == QUARANTINE_RUNS[-1])
    held, loaded = table.quarantine(), table.read().select("_row_id", F.col("updated_at").alias("loaded_as"))
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("updated_at", "held_at", "settled_at", "loaded_as")]
    return held.join(loaded, "_row_id", "left").select("_row_id", "state", *times)


@query("schema_sync")
def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two loads of different schemas: keys and priorities widen from int
    to long, prices from two to four decimals, a column goes and one comes."""
    from pyspark.sql import functions as F
    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.session import scratch_dir
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    first = orders.where(F.col("o_orderkey") % 3 != 0).select(
        F.col("o_orderkey").cast("int").alias("order_key"), F.col("o_custkey").cast("int").alias("customer"), "at",
        price.cast("decimal(12,2)").alias("price"), F.col("o_orderstatus").alias("status"))
    second = orders.where(F.col("o_orderkey") % 3 != 1).select(
        F.col("o_orderkey").cast("long").alias("order_key"), (F.col("o_custkey").cast("long") + 3_000_000_000).alias("customer"), "at",
        (price.cast("decimal(18,4)") + F.lit(0.0001).cast("decimal(18,4)")).cast("decimal(14,4)").alias("price"),
        F.col("o_orderpriority").alias("priority"))
    table = ParquetTarget(spark, scratch_dir(spark, "schema-sync"), "order_key", "at")
    table.apply(first)
    table.apply(second)
    return table.read().select("order_key", "customer", "price", "priority")


@query("incremental_filter")
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-run extract: raw invoices at or after the first run's watermark."""
    from pyspark.sql import functions as F
    from ledgerline.operators.incremental import incremental_extract, next_watermark
    from ledgerline.sources.testdata import raw_invoices
    raw = raw_invoices(spark, sf_dir)
    first = raw.where(F.col("updated_at") < F.lit(INVOICE_FIRST_RUN_BEFORE).cast("timestamp"))
    wm = next_watermark(first, "updated_at")
    return incremental_extract(raw, "updated_at", wm)


@query("incremental_invoices")
def incremental_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stg_invoices built by two incremental runs (must equal a full refresh).
    The existence flag is computed at read time, so a subscription that
    arrives after its invoices still validates them."""
    from pyspark.sql import functions as F
    from ledgerline.operators.existence import existence_flag
    from ledgerline.operators.incremental import incremental_extract, next_watermark, upsert
    from ledgerline.operators.staging import INVOICE_COLUMNS, type_invoices
    from ledgerline.session import stored
    from ledgerline.sources.raw import RAW_KEY
    from ledgerline.sources.testdata import raw_subscriptions
    raw = _landed_invoices(spark, sf_dir)
    tie = ["amount", "currency", "status", "invoice_date", "subscription_id"]
    run1 = raw.where(F.col("updated_at") < F.lit(INVOICE_FIRST_RUN_BEFORE).cast("timestamp"))
    # The target after run 1 is a stored table in a real load.
    t1 = stored(upsert(None, type_invoices(run1), RAW_KEY, "updated_at", tie), "invoices-run-1")
    wm = next_watermark(t1, "updated_at")
    run2 = type_invoices(incremental_extract(raw, "updated_at", wm))
    t2 = upsert(t1, run2, RAW_KEY, "updated_at", tie)
    return existence_flag(t2, "subscription_id", raw_subscriptions(spark, sf_dir), "subscription_id",
                          "has_valid_subscription").select(*INVOICE_COLUMNS)


@query("cursor_guard")
def cursor_guard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per raw table: rows a sync at SYNC_TIME accepts vs quarantines, and the
    watermark with and without the guard."""
    from pyspark.sql import functions as F
    from ledgerline.operators.incremental import guard_summary
    from ledgerline.sources.testdata import raw_tables
    parts = [guard_summary(df, "updated_at", SYNC_TIME).select(F.lit(name).alias("resource"), "*")
             for name, df in raw_tables(spark, sf_dir).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _history_of(spark: SparkSession, snapshots: list[DataFrame], key: str) -> DataFrame:
    """The history after one run per snapshot, through the written table."""
    from ledgerline.operators.history import VERSION_ID, apply_snapshot, history_target
    from ledgerline.session import scratch_dir
    table = history_target(spark, scratch_dir(spark, "history"), key, "updated_at")
    for snapshot in snapshots:
        apply_snapshot(table, snapshot)
    return table.read().drop(VERSION_ID)


def _day_after_last(events: DataFrame):
    """The day after the last event (None without events): one row to the driver."""
    from pyspark.sql import functions as F
    return events.agg(F.date_add(F.max("ts").cast("date"), 1)).first()[0]


def _event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ledgerline.operators.dedup import keep_latest
    ev = _events(spark, sf_dir)
    runs = [F.lit(r).cast("timestamp_ntz") for r in (*SNAPSHOT_RUNS, _day_after_last(ev))]
    states = [keep_latest(ev.where(F.col("ts") < run), "user_id", "ts", ["event_id"]) for run in runs]
    return _history_of(spark, [s.select("user_id", "event_id", "event_type", "value", F.col("ts").alias("updated_at"))
                               for s in states], "user_id")


@query("scd2_history")
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history of each user's state after three snapshot runs."""
    return _event_history(spark, sf_dir)


@query("point_in_time_state")
def point_in_time_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and value per state at each day start, read from the history."""
    from pyspark.sql import functions as F
    from ledgerline.operators.history import valid_periods
    hist = _event_history(spark, sf_dir)
    return (valid_periods(hist, STATE_FIRST_DAY, _day_after_last(_events(spark, sf_dir)), unit="day")
            .groupBy("period_start", "event_type")
            .agg(F.count(F.lit(1)).alias("users"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("value_total")))


# --------------------------------------------------------- fx and helpers

def monthly_sek_rates(invoices: DataFrame) -> DataFrame:
    """A dated rate table derived from the data: one SEK rate per invoice
    month (a fixed rule of the month number) and EUR at 1 since 1990."""
    from decimal import Decimal

    from pyspark.sql import functions as F
    from ledgerline.functions.columns import month_start
    months = invoices.select(month_start("invoice_date").alias("valid_from")).where(
        F.col("valid_from").isNotNull()).distinct()
    sek = months.select(F.lit("SEK").alias("currency"), "valid_from",
                        (F.lit(Decimal("0.085")) + F.lit(Decimal("0.001")) * (F.month("valid_from") - 1))
                        .cast("decimal(18,6)").alias("rate_to_eur"))
    eur = invoices.sparkSession.createDataFrame(
        [("EUR", __import__("datetime").date(1990, 1, 1), Decimal(1))],
        "currency string, valid_from date, rate_to_eur decimal(18,6)")
    return sek.unionByName(eur)


@query("fx_convert")
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EUR amounts through a join to the (currency, rate) table — must equal
    the fixed CASE conversion in staging."""
    from ledgerline.functions.fx import convert_with_rates, rates_frame
    inv = models(spark, sf_dir).stg_invoices.select("invoice_id", "currency", "amount")
    return convert_with_rates(inv, "amount", "currency", rates_frame(spark))


@query("fx_asof")
def fx_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EUR amounts at the rate in force on each invoice date."""
    from ledgerline.functions.fx import convert_with_dated_rates
    inv = models(spark, sf_dir).stg_invoices.select("invoice_id", "currency", "invoice_date", "amount")
    return convert_with_dated_rates(inv, "amount", "currency", "invoice_date",
                                    monthly_sek_rates(inv))


LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_latest")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest line item per (order, line number) by ship date."""
    from ledgerline.operators.dedup import keep_latest
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return keep_latest(li, ["l_orderkey", "l_linenumber"], LINEITEM_ORDER[0], LINEITEM_ORDER[1:])


@query("orphan_keys")
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriptions whose customer does not exist among clean customers."""
    from ledgerline.operators.existence import orphans
    m = models(spark, sf_dir)
    return orphans(m.stg_subscriptions.select("subscription_id", "customer_id"), "customer_id",
                   m.stg_customers, "customer_id")


@query("existence_flag")
def existence_flag_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with a flag: does it have at least one line item?"""
    from ledgerline.operators.existence import existence_flag
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return existence_flag(o, "o_orderkey", li, "l_orderkey", "has_lineitems")


def _table_resolver(spark: SparkSession, sf_dir: str):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("dq_unique_combination")
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of column combinations on the source tables."""
    from ledgerline.operators.quality import Check, run_checks
    checks = [Check("unique_combination", "lineitem", columns=("l_orderkey", "l_linenumber")),
              Check("unique_combination", "orders", columns=("o_custkey", "o_orderdate"), severity="warn"),
              Check("unique", "documents", "text", severity="warn"),
              Check("unique", "events", "event_id")]
    from ledgerline.sources.testdata import TEST_AS_OF
    return run_checks(spark, checks, _table_resolver(spark, sf_dir), TEST_AS_OF)


@query("profile_table")
def profile_raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defect profile of the three raw billing tables: text defects per column,
    repeated keys and rows, values out of their set, orphans."""
    from ledgerline.operators.profiling import profile_sets, profile_table
    from ledgerline.plans.checks import CURRENCIES, INVOICE_STATUSES, SUBSCRIPTION_STATUSES
    from ledgerline.sources.raw import RAW_COLUMNS
    from ledgerline.sources.testdata import raw_tables
    raw = raw_tables(spark, sf_dir)
    domains = {"subscriptions": {"status": SUBSCRIPTION_STATUSES},
               "invoices": {"status": INVOICE_STATUSES, "currency": CURRENCIES}}
    parents = {"subscriptions": {"customer_id": (raw["customers"], "customer_id")},
               "invoices": {"subscription_id": (raw["subscriptions"], "subscription_id")}}
    parts = [profile_table(df, name, RAW_COLUMNS[name]) for name, df in raw.items()]
    parts += [profile_sets(df, name, RAW_COLUMNS[name][0], RAW_COLUMNS[name], domains.get(name, {}), parents.get(name, {}))
              for name, df in raw.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("source_freshness")
def source_freshness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest cursor per raw table against the sync time."""
    from ledgerline.operators.profiling import source_freshness
    from ledgerline.sources.testdata import raw_tables
    parts = [source_freshness(df, name, "updated_at", SYNC_TIME)
             for name, df in raw_tables(spark, sf_dir).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("stream_sync_events")
def stream_sync_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed synced through a Structured Streaming availableNow run
    into a stored table (in the shared checkpoint folder); the result is
    the table's committed state: latest event per user."""
    import os

    from pyspark.sql import functions as F

    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.session import scratch_dir
    from ledgerline.streaming.sync import file_stream, sync_available
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (file_stream(spark, sf_dir, schema, glob="events.parquet")
              .select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                      "event_type", "value"))
    root = scratch_dir(spark, "stream-sync-events")
    table = ParquetTarget(spark, os.path.join(root, "table"), "user_id", "ts")
    return sync_available(stream, table, os.path.join(root, "checkpoint"), ["event_id"])


def _subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is learnt of each clean subscription, and when: at its start the plan,
    price, and status (active if it has an end), at each EUR bill the price
    billed, at its end the end date and final status."""
    from pyspark.sql import functions as F
    m = models(spark, sf_dir)
    known = ["plan_name", "monthly_price", "status", "start_date", "end_date"]
    subs = m.subscriptions_core.select("subscription_id", "updated_at", *known)
    none = {c: F.lit(None).cast(subs.schema[c].dataType) for c in known}

    def event(df: DataFrame, at, **values):
        return df.select("subscription_id", at.cast("timestamp").alias("updated_at"),
                         *[values.get(c, none[c]).alias(c) for c in known])
    started = event(subs, F.col("updated_at"), plan_name=F.col("plan_name"), monthly_price=F.col("monthly_price"),
                    start_date=F.col("start_date"),
                    status=F.when(F.col("end_date").isNotNull(), F.lit("active")).otherwise(F.col("status")))
    ended = event(subs.where(F.col("end_date").isNotNull()), F.col("end_date"), status=F.col("status"), end_date=F.col("end_date"))
    billed = event(m.typed_invoices.where(F.col("amount_eur").isNotNull() & F.col("invoice_date").isNotNull())
                   .join(subs.select("subscription_id"), "subscription_id", "left_semi"),
                   F.col("invoice_date"), monthly_price=F.col("amount_eur"))
    return started.unionByName(billed).unionByName(ended)


def subscription_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history of the clean subscriptions from their whole change feed."""
    from ledgerline.operators.history import VERSION_ID, carried_forward, history_from_feed
    state = ["plan_name", "monthly_price", "status", "start_date", "end_date"]
    feed = carried_forward(_subscription_events(spark, sf_dir), ["subscription_id"], "updated_at", state)
    return history_from_feed(feed, "subscription_id", "updated_at", state).drop(VERSION_ID)


def _last_month(history: DataFrame):
    """The month of the newest version (None without one): one row to the driver."""
    from pyspark.sql import functions as F
    return history.agg(F.trunc(F.max("valid_from"), "MM")).first()[0]


@query("scd2_subscriptions")
def scd2_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every clean subscription."""
    from pyspark.sql import functions as F
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("updated_at", "valid_from", "valid_to")]
    return subscription_history(spark, sf_dir).select(
        "subscription_id", "plan_name", "monthly_price", "status", "start_date", "end_date", *times)


@query("point_in_time_mrr")
def point_in_time_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRR as known at each month start up to the newest version's month.

    At month start M a subscription counts with the version valid at M if that
    version has no end date or ends on/after M.
    """
    from ledgerline.operators.history import mrr_at_month_starts
    from ledgerline.session import stored
    history = stored(subscription_history(spark, sf_dir), "subscription-history")
    return mrr_at_month_starts(history, _last_month(history))


@query("mrr_as_known")
def mrr_as_known_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRR of each month as known at each month start from then on."""
    from ledgerline.operators.history import mrr_as_known
    from ledgerline.session import stored
    history = stored(subscription_history(spark, sf_dir), "subscription-history")
    return mrr_as_known(history, _last_month(history))


@query("mrr_incremental")
def mrr_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRR by month and plan after two loads of subscriptions and invoices: the second
    adds what its subscriptions contribute now less what they did before."""
    from pyspark.sql import functions as F
    from ledgerline.operators.incremental import incremental_extract, next_watermark, upsert
    from ledgerline.operators.incremental_marts import TABLES, mrr_contribution, refreshed_mrr, touched_subscriptions
    from ledgerline.operators.metrics import mrr_levels
    from ledgerline.session import stored
    from ledgerline.sources.raw import RAW_KEY
    source = raw_tables(spark, sf_dir)
    first = F.col("updated_at") < F.lit(INVOICE_FIRST_RUN_BEFORE).cast("timestamp")
    before = {t: stored(source[t].where(first), f"mrr-{t}") for t in TABLES}
    totals = stored(mrr_contribution(before), "mrr-totals")
    batch = {t: stored(incremental_extract(source[t], "updated_at", next_watermark(before[t], "updated_at")), f"mrr-batch-{t}")
             for t in TABLES}
    after = {t: upsert(before[t], batch[t], RAW_KEY, "updated_at") for t in TABLES}
    touched = stored(touched_subscriptions(before, batch), "mrr-touched")
    return mrr_levels(refreshed_mrr(totals, before, after, touched), TEST_AS_OF)


@query("fx_asof_large")
def fx_asof_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EUR amounts of all invoices at the rate in force on their date, from a table with
    a rate per currency and most billing days; EUR bills (the most by far) have rates too."""
    from pyspark.sql import functions as F
    from ledgerline.functions.fx import convert_asof
    inv = models(spark, sf_dir).typed_invoices.select("invoice_id", "currency", "invoice_date", "amount")
    day = F.datediff("invoice_date", F.lit("1990-01-01").cast("date"))
    rates = (inv.where((F.pmod(day, F.lit(7)) < 3) & (F.month("invoice_date") % 4 != 2)).select(
        "currency", F.col("invoice_date").alias("valid_from"),
        (F.lit(50_000) + F.pmod(day * 37, F.lit(9_973))).alias("millionths")).distinct()
        .select("currency", "valid_from", (F.col("millionths").cast("decimal(18,6)") / 1_000_000).cast("decimal(18,6)")
                .alias("rate_to_eur")))
    return convert_asof(inv, "amount", "currency", "invoice_date", rates)


@query("missed_rows")
def missed_rows_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoices that two loads by cursor missed: rows that came after the first
    load with a cursor below its watermark, and amounts corrected later under the old
    cursor, each with the bill it has to be loaded with again."""
    from pyspark.sql import functions as F
    from ledgerline.operators.incremental import incremental_extract, next_watermark, upsert
    from ledgerline.operators.reconcile import differing_rows, missed_rows
    from ledgerline.session import stored
    source = _landed_invoices(spark, sf_dir)
    k = F.col("_row_id")
    seen_first = source.where((F.col("updated_at") < F.lit(INVOICE_FIRST_RUN_BEFORE).cast("timestamp")) & (k % 97 != 0)) \
        .withColumn("amount", F.when(k % 89 == 0, F.concat("amount", F.lit("0"))).otherwise(F.col("amount")))
    first = stored(seen_first, "missed-first")
    batch = incremental_extract(source, "updated_at", next_watermark(first, "updated_at"))
    table = stored(upsert(first, batch, "_row_id", "updated_at"), "missed-second")
    kinds = stored(differing_rows(source, table, "_row_id"), "missed-kinds")
    return missed_rows(source, table, "_row_id", kinds=kinds).join(kinds, "_row_id").select("_row_id", "invoice_id", "amount", "kind")


@query("customer_ltv_ranked")
def customer_ltv_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's place in the presentation order of the LTV mart."""
    from ledgerline.operators.ranking import positions
    from ledgerline.plans.models import presentation_order
    ltv = models(spark, sf_dir).customer_ltv.select("customer_id", "customer_name", "ltv")
    return positions(ltv, presentation_order("customer_ltv"))


@query("mrr_ranked")
def mrr_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's place in the presentation order of the MRR mart."""
    from ledgerline.operators.ranking import positions
    from ledgerline.plans.models import presentation_order
    return positions(models(spark, sf_dir).mrr_by_month_plan, presentation_order("mrr_by_month_plan"))
