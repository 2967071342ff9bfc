"""Incremental MRR, as-of rates in blocks, and rows an incremental load missed."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.fx import convert_asof
from ledgerline.operators.incremental import upsert
from ledgerline.operators.incremental_marts import TABLES, mrr_contribution, refreshed_mrr, touched_subscriptions
from ledgerline.operators.metrics import churn_base, mrr_by_month_plan, mrr_levels, mrr_running_sum
from ledgerline.operators.periods import effective_dates, subscription_months
from ledgerline.operators.reconcile import differing_rows, missed_rows
from ledgerline.operators.staging import dedup_subscriptions, type_invoices

AS_OF = dt.date(2024, 6, 15)
SUBS = "_row_id long, subscription_id string, customer_id string, plan_name string, monthly_price string, " \
       "start_date string, end_date string, status string, updated_at timestamp"
BILLS = "_row_id long, invoice_id string, subscription_id string, invoice_date string, amount string, " \
        "currency string, status string, updated_at timestamp"


def _day(rng, blank=0.1):
    return "" if rng.random() < blank else str(dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(700)))


def _sub(rng, row):
    return (row, rng.choice([None, *(f"S{i}" for i in range(12))]), "C1", rng.choice(["starter", "growth", None]),
            rng.choice(["", "10.00", "25.50", "-3.00"]), _day(rng), _day(rng, 0.5), rng.choice(["active", "cancelled ", "paused"]),
            dt.datetime(2024, 1, 1))


def _bill(rng, row):
    return (row, f"I{row}", rng.choice([None, *(f"S{i}" for i in range(14))]), _day(rng), "5.00", "EUR", "paid", dt.datetime(2024, 1, 1))


def _frames(spark, subs, bills):
    return {"subscriptions": spark.createDataFrame(subs, SUBS), "invoices": spark.createDataFrame(bills, BILLS)}


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshed_mrr_equals_full_refresh(spark, seed):
    """Loads that change prices, plans, ends and bills, and move rows to other subscriptions."""
    rng = random.Random(seed)
    before = _frames(spark, [_sub(rng, r) for r in range(15)], [_bill(rng, r) for r in range(20)])
    totals = mrr_contribution(before)
    batch = _frames(spark, [_sub(rng, r) for r in rng.sample(range(25), 6)], [_bill(rng, r) for r in rng.sample(range(30), 6)])
    after = {t: upsert(before[t], batch[t], "_row_id", "updated_at") for t in TABLES}
    touched = touched_subscriptions(before, batch)
    for as_of in (AS_OF, dt.date(2025, 6, 1)):
        got = mrr_levels(refreshed_mrr(totals, before, after, touched), as_of)
        full = mrr_by_month_plan(subscription_months(
            effective_dates(dedup_subscriptions(after["subscriptions"]), type_invoices(after["invoices"])), as_of))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, full.select(*got.columns).collect()))


def test_refresh_with_empty_load_and_first_load(spark):
    rng = random.Random(3)
    some = _frames(spark, [_sub(rng, r) for r in range(10)], [_bill(rng, r) for r in range(10)])
    none = {t: some[t].where("false") for t in TABLES}
    totals = mrr_contribution(some)
    same = refreshed_mrr(totals, some, some, touched_subscriptions(some, none))
    first = refreshed_mrr(mrr_contribution(none), none, some, touched_subscriptions(none, some))
    want = sorted(map(repr, mrr_levels(totals, AS_OF).collect()))
    assert want and want == sorted(map(repr, mrr_levels(same, AS_OF).collect()))
    assert want == sorted(map(repr, mrr_levels(first, AS_OF).collect()))


def test_refresh_reads_touched_subscriptions_only(spark):
    rng = random.Random(4)
    raw = _frames(spark, [_sub(rng, r) for r in range(10)], [_bill(rng, r) for r in range(10)])
    one = spark.createDataFrame([("S3",)], "subscription_id string")
    alone = {t: raw[t].where("subscription_id = 'S3'") for t in TABLES}
    assert sorted(map(repr, mrr_contribution(raw, one).collect())) == sorted(map(repr, mrr_contribution(alone).collect()))


def _rates(spark, rows):
    return spark.createDataFrame(rows, "currency string, valid_from date, rate_to_eur decimal(18,6)")


@pytest.mark.parametrize("block", ["MONTH", "DAY"])
def test_asof_against_brute_force(spark, block):
    rng = random.Random(5)
    first = dt.date(2023, 1, 1)
    rates = [(rng.choice(["SEK", "USD", None]), first + dt.timedelta(rng.randrange(20, 400)), Decimal(rng.randrange(1, 999)) / 1000)
             for _ in range(40)] + [("SEK", None, Decimal(7)), ("SEK", dt.date(2023, 3, 1), None),
                                    ("USD", dt.date(2023, 2, 2), Decimal(1)), ("USD", dt.date(2023, 2, 2), Decimal(2))]
    facts = [(i, rng.choice(["SEK", "USD", "NOK", " SEK", None]), rng.choice([None, *[first + dt.timedelta(rng.randrange(900))
             for _ in range(9)]]), rng.choice([None, Decimal("10.00"), Decimal("33.33")])) for i in range(120)]
    df = spark.createDataFrame(facts, "id long, currency string, day date, amount decimal(18,2)")
    got = {r.id: r.amount_eur for r in convert_asof(df, "amount", "currency", "day", _rates(spark, rates), block=block).collect()}
    assert len(got) == len(facts)
    hits = 0
    for i, ccy, day, amount in facts:
        held = [(d, r) for c, d, r in rates if c and c == ccy and d and r is not None and day and d <= day]
        want = None
        if held and amount is not None:
            want = (amount * max(held)[1]).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
            hits += 1
        assert got[i] == want, (i, ccy, day)
    assert hits > 20


def test_asof_of_empty_tables_and_plan(spark):
    df = spark.createDataFrame([(1, "SEK", dt.date(2023, 1, 1), Decimal(1))], "id long, currency string, day date, amount decimal(18,2)")
    none = _rates(spark, [])
    assert [r.amount_eur for r in convert_asof(df, "amount", "currency", "day", none).collect()] == [None]
    assert convert_asof(df.where("false"), "amount", "currency", "day", none).collect() == []
    plan = convert_asof(df, "amount", "currency", "day", none)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k string, g int, v string, n int")


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_differing_rows(spark, buckets):
    source = _rows(spark, [("a", 1, "x", 1), ("b", 1, None, 1), ("c", 1, "x", None), ("d", 1, "x", 1), ("d", 1, "x", 1),
                           (None, 1, "p", 1), (None, 1, "q", 1), ("f", 1, "late", 2), ("g", None, "x", 1)])
    target = _rows(spark, [("a", 1, "x", 1), ("b", 1, "1", None), ("c", 1, "y", None), ("d", 1, "x", 1),
                           (None, 1, "p", 1), (None, 1, "q", 1), ("e", 1, "x", 1), ("g", None, "x", 1)])
    got = {(r.k, r.g): r.kind for r in differing_rows(source, target, ["k", "g"], buckets=buckets).collect()}
    assert got == {("b", 1): "changed", ("c", 1): "changed", ("d", 1): "missing", ("e", 1): "extra", ("f", 1): "missing"}
    again = missed_rows(source, target, ["k", "g"], buckets=buckets).collect()
    assert sorted(r.k for r in again) == ["b", "c", "d", "d", "f"]
    assert differing_rows(source, source, ["k", "g"], buckets=buckets).collect() == []
    # NULL moved between neighbouring columns is a change; a NULL key is compared as a collection
    assert {r.k: r.kind for r in differing_rows(source, target.where("k is not null or v = 'p'"), "k", buckets=buckets).collect()}[None] == "missing"


def test_differing_rows_of_empty_tables_and_types(spark):
    source = _rows(spark, [("a", 1, "x", 1), ("b", 2, "y", 2)])
    none = source.where("false")
    assert {r.kind for r in differing_rows(source, none, "k").collect()} == {"missing"}
    assert {r.kind for r in differing_rows(none, source, "k").collect()} == {"extra"}
    assert differing_rows(none, none, "k").collect() == []
    wide = source.select(F.col("n").cast("long").alias("n"), "v", "g", "k", F.lit(1).alias("other"))
    assert differing_rows(source, wide, "k").collect() == []


def test_a_null_subscription_is_revenue_but_no_subscription(spark):
    eff = spark.createDataFrame(
        [(None, "growth", Decimal("9.00"), "cancelled", dt.date(2024, 1, 5), dt.date(2024, 2, 1)),
         ("S1", "scale", Decimal("5.00"), "active", dt.date(2024, 2, 1), None)],
        "subscription_id string, plan_name string, monthly_price decimal(18,2), status string, start_date date, effective_end_date date") \
        .withColumn("customer_id", F.lit("C"))
    grain = mrr_by_month_plan(subscription_months(eff, AS_OF))
    mart = mrr_running_sum(eff, AS_OF)
    assert sorted(map(repr, mart.collect())) == sorted(map(repr, grain.select(*mart.columns).collect()))
    base = {r.month_start: r for r in churn_base(eff, AS_OF).collect()}
    assert sorted(base) == [dt.date(2024, m, 1) for m in range(1, 7)]
    feb, march = base[dt.date(2024, 2, 1)], base[dt.date(2024, 3, 1)]
    assert (feb.active_subscriptions_start, feb.mrr_start, feb.churned_subscriptions, feb.churned_mrr) == (0, Decimal("9.00"), 0, Decimal("9.00"))
    assert (march.active_subscriptions_start, march.mrr_start) == (1, Decimal("14.00"))


def test_positions_number_the_whole_table(spark):
    from ledgerline.operators.ranking import positions
    rows = [(i, (i * 37) % 11 if i % 5 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, score int").repartition(7)
    got = positions(df, [F.col("score").desc(), F.col("id")])
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))  # NULL scores last
    assert [(r.id, r.score, r.position) for r in got.orderBy("position").collect()] == \
        [(i, s, k) for k, (i, s) in enumerate(want, 1)]
    assert positions(df.where("id < 0"), [F.col("id")]).count() == 0
    with pytest.raises(ValueError):
        positions(df, [F.col("id")], name="score")


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_invoices_and_upserts_shuffle_their_rows_once(spark):
    from ledgerline.operators.incremental import upsert
    from ledgerline.sources.testdata import raw_invoices
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        assert _shuffles(raw_invoices(spark, "/root/testdata/sf0.001")) == 2      # line items and orders, by order
        df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, c int")
        out = upsert(df, df.where("c > 1"), "k", "c")
        assert out._jdf.queryExecution().executedPlan().toString().count("Window [row_number") == 1
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_missed_rows_take_kinds_that_are_at_hand(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k int, v string")
    kinds = differing_rows(source, target, "k").localCheckpoint()
    assert {tuple(r) for r in kinds.collect()} == {(2, "changed"), (3, "missing"), (4, "extra")}
    out = missed_rows(source, target, "k", kinds=kinds)
    assert {tuple(r) for r in out.collect()} == {(2, "b"), (3, "c")} == {tuple(r) for r in missed_rows(source, target, "k").collect()}
    assert "xxhash64" not in out._jdf.queryExecution().optimizedPlan().toString()
