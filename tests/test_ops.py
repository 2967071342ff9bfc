"""Checks, incremental loads, history, FX, streaming, plan shape."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.quality import Check, CheckFailed, raise_on_error, run_checks

TS = dt.datetime


def _ev(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, ts timestamp")


# ------------------------------------------------------------------- checks
def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", True), (2, None, False), (None, "zz", True)],
                               "id int, code string, ok boolean")
    checks = [Check("unique", "t", "id"), Check("not_null", "t", "id", "warn"),
              Check("accepted_values", "t", "code", values=("a", "b")),
              Check("flag_equals", "t", "ok", "warn", values=(True,)),
              Check("expression", "t", name="id_positive", predicate="id <= 0"),
              Check("unique_combination", "t", columns=("id", "code"))]
    res = {r.check_name: r for r in run_checks(spark, checks, lambda n: df, dt.date(2024, 1, 1)).collect()}
    assert res["unique_t_id"].failures == 1 and res["unique_t_id"].status == "error"
    assert res["not_null_t_id"].failures == 1 and res["not_null_t_id"].status == "warn"
    assert res["accepted_values_t_code"].failures == 1        # 'zz' once; NULL passes
    assert res["flag_equals_t_ok"].failures == 1
    assert res["id_positive"].status == "pass"
    assert res["unique_combination_t_id_code"].failures == 0
    with pytest.raises(CheckFailed):
        raise_on_error(run_checks(spark, checks, lambda n: df, dt.date(2024, 1, 1)))


def test_clean_data_passes_all_checks(spark):
    from ledgerline.plans.checks import column_checks, singular_checks
    from ledgerline.plans.models import BillingModels
    from tests.fixtures import billing_raw
    raw = billing_raw(
        spark,
        [(1, "C1", "Ann", "a@x", "SE", "2023-01-01")],
        [("S1", "C1", "starter", "29.00", "2024-01-10", "", "active"),
         ("S2", "C1", "growth", "99.00", "2024-01-10", "2024-03-10", "cancelled")],
        [("I1", "S1", "2024-01-10", "29.00", "EUR", "paid"),
         ("I2", "S2", "2024-02-10", "99.00", "SEK", "open")])
    m = BillingModels(raw, dt.date(2024, 6, 15))
    res = run_checks(spark, column_checks() + singular_checks(), m.model, m.as_of)
    assert [r.check_name for r in res.where("status != 'pass'").collect()] == []
    assert res.count() == 47


# -------------------------------------------------------------- incremental
def test_upsert_and_keep_latest_in_batch(spark):
    from ledgerline.operators.incremental import upsert
    t = _ev(spark, [("a", "1", TS(2024, 1, 1)), ("b", "1", TS(2024, 1, 1))])
    b = _ev(spark, [("a", "2", TS(2024, 1, 2)), ("a", "3", TS(2024, 1, 3)), ("c", "1", TS(2024, 1, 2))])
    out = {r.k: r.v for r in upsert(t, b, "k", "ts").collect()}
    assert out == {"a": "3", "b": "1", "c": "1"}                       # N15


def test_inclusive_vs_strict_cursor(spark):
    from ledgerline.operators.incremental import incremental_extract
    src = _ev(spark, [("a", "1", TS(2024, 1, 1)), ("late", "1", TS(2024, 1, 1)), ("b", "1", TS(2024, 1, 2))])
    wm = TS(2024, 1, 1)
    assert {r.k for r in incremental_extract(src, "ts", wm).collect()} == {"a", "late", "b"}
    assert {r.k for r in incremental_extract(src, "ts", wm, strict=True).collect()} == {"b"}  # N7


def test_cursor_guard(spark):
    from ledgerline.operators.incremental import cursor_guard, next_watermark
    src = _ev(spark, [("a", "1", TS(2024, 1, 1)), ("poison", "1", TS(2031, 1, 1))])
    g = cursor_guard(src, "ts", TS(2024, 6, 1))
    assert [r.k for r in g.quarantined.collect()] == ["poison"]
    assert next_watermark(g.good, "ts") == TS(2024, 1, 1)               # N9


def test_incremental_loads_equal_a_full_one(spark, tmp_dir):
    from ledgerline.operators.targets import ParquetTarget
    rows = [("a", "1", TS(2024, 1, 1)), ("b", "1", TS(2024, 1, 2)), ("a", "2", TS(2024, 1, 3)),
            ("c", "1", TS(2024, 1, 3)), ("b", "2", TS(2024, 1, 5))]
    full = ParquetTarget(spark, os.path.join(tmp_dir, "full"), "k", "ts")
    full.load(_ev(spark, rows), full_refresh=True)
    inc = ParquetTarget(spark, os.path.join(tmp_dir, "inc"), "k", "ts")
    inc.load(_ev(spark, rows[:2]))
    r2 = inc.load(_ev(spark, rows[:4]))
    inc.load(_ev(spark, rows))
    inc.load(_ev(spark, rows))                                         # re-run: harmless
    assert r2["run"] == 2 and r2["rows"] == 3 and r2["inserted"] == 1
    a = sorted(map(tuple, full.read().collect()))
    b = sorted(map(tuple, inc.read().collect()))
    assert a == b and inc.watermark() == TS(2024, 1, 5)


def test_schema_sync_all_columns(spark):
    from ledgerline.operators.incremental import upsert
    t = spark.createDataFrame([("a", 1, "old")], "k string, v int, gone string")
    b = spark.createDataFrame([("b", 2, "new")], "k string, v int, added string")
    out = upsert(t, b, "k")
    assert out.columns == ["k", "v", "added"]
    assert {r.k: r.added for r in out.collect()} == {"a": None, "b": "new"}


# ------------------------------------------------------------------ history
def _snap(spark, rows):
    return spark.createDataFrame(rows, "id string, status string, updated_at timestamp")


def test_scd2_runs(spark):
    from ledgerline.operators.history import as_of, scd2_apply
    h1 = scd2_apply(None, _snap(spark, [("s1", "active", TS(2024, 1, 1)), ("s2", "active", TS(2024, 1, 1))]),
                    "id", "updated_at")
    assert h1.count() == 2
    h1b = scd2_apply(h1, _snap(spark, [("s1", "active", TS(2024, 1, 1)), ("s2", "active", TS(2024, 1, 1))]),
                     "id", "updated_at")
    assert h1b.count() == 2                                            # unchanged re-run: 0 new
    h2 = scd2_apply(h1b, _snap(spark, [("s1", "cancelled", TS(2024, 2, 1)),
                                       ("s2", "paused", TS(2023, 12, 1)),   # out of order: ignored
                                       ("s3", "active", TS(2024, 2, 1))]), "id", "updated_at")
    rows = h2.collect()
    assert len(rows) == 4
    cur = {r.id: r.status for r in rows if r.valid_to is None}
    assert cur == {"s1": "cancelled", "s2": "active", "s3": "active"}
    closed = [r for r in rows if r.valid_to is not None]
    assert len(closed) == 1 and closed[0].valid_to == TS(2024, 2, 1)
    assert {r.id: r.status for r in as_of(h2, TS(2024, 1, 15)).collect()} == {"s1": "active", "s2": "active"}
    # idempotent: applying the same snapshot again changes nothing
    h3 = scd2_apply(h2, _snap(spark, [("s1", "cancelled", TS(2024, 2, 1)), ("s3", "active", TS(2024, 2, 1))]),
                    "id", "updated_at")
    assert sorted(map(tuple, h3.collect())) == sorted(map(tuple, rows))


def test_valid_periods(spark):
    from ledgerline.operators.history import valid_periods
    h = spark.createDataFrame([("a", TS(2024, 1, 1, 0, 0), TS(2024, 1, 3, 0, 0)),
                               ("b", TS(2024, 1, 1, 12, 0), None)],
                              "id string, valid_from timestamp, valid_to timestamp")
    got = sorted((r.id, r.period_start) for r in valid_periods(h, "2024-01-01", "2024-01-04").collect())
    d = dt.date
    assert got == [("a", d(2024, 1, 1)), ("a", d(2024, 1, 2)),
                   ("b", d(2024, 1, 2)), ("b", d(2024, 1, 3)), ("b", d(2024, 1, 4))]


# ---------------------------------------------------------------------- fx
def test_fx_forms(spark):
    from ledgerline.functions.fx import convert_to_eur, convert_with_dated_rates, convert_with_rates, rates_frame
    df = spark.createDataFrame([(Decimal("100.00"), "SEK", dt.date(2024, 1, 5)),
                                (Decimal("100.00"), "EUR", dt.date(2024, 2, 5)),
                                (Decimal("100.00"), " EUR", dt.date(2024, 2, 5)),
                                (Decimal("100.00"), "SEK", dt.date(2024, 2, 5))],
                               "amount decimal(18,2), currency string, d date")
    a = [r.e for r in df.select(convert_to_eur("amount", "currency").alias("e")).collect()]
    assert a == [Decimal("8.80"), Decimal("100.00"), None, Decimal("8.80")]
    b = {(r.currency, r.d): r.amount_eur for r in convert_with_rates(df, "amount", "currency", rates_frame(spark)).collect()}
    assert b[("SEK", dt.date(2024, 1, 5))] == Decimal("8.80") and b[(" EUR", dt.date(2024, 2, 5))] is None
    rates = spark.createDataFrame([("SEK", dt.date(2024, 1, 1), Decimal("0.09")),
                                   ("SEK", dt.date(2024, 2, 1), Decimal("0.1"))],
                                  "currency string, valid_from date, rate_to_eur decimal(18,6)")
    c = {(r.currency, r.d): r.amount_eur for r in
         convert_with_dated_rates(df, "amount", "currency", "d", rates).collect()}
    assert c[("SEK", dt.date(2024, 1, 5))] == Decimal("9.00")
    assert c[("SEK", dt.date(2024, 2, 5))] == Decimal("10.00")
    assert c[("EUR", dt.date(2024, 2, 5))] is None


def test_round_ratio_half_up(spark):
    from ledgerline.functions.columns import round_ratio
    df = spark.createDataFrame([(1, 8), (1, 32), (5, 0)], "a long, b long")
    got = [r.r for r in df.select(round_ratio(F.col("a"), F.col("b"), 2).alias("r")).collect()]
    assert got == [Decimal("0.13"), Decimal("0.03"), None]


# ---------------------------------------------------------------- streaming
def test_stream_sync_two_batches(spark, tmp_dir):
    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.streaming.sync import file_stream, sync_available
    landing = os.path.join(tmp_dir, "landing")
    _ev(spark, [("a", "1", TS(2024, 1, 1)), ("b", "1", TS(2024, 1, 1))]).write.parquet(landing + "/f1")
    schema = spark.read.parquet(landing + "/f1").schema
    table = ParquetTarget(spark, os.path.join(tmp_dir, "t"), "k", "ts")
    ck = os.path.join(tmp_dir, "ck")
    out = sync_available(file_stream(spark, landing + "/*", schema), table, ck)
    assert out.count() == 2
    _ev(spark, [("a", "2", TS(2024, 1, 2))]).write.parquet(landing + "/f2")
    out = sync_available(file_stream(spark, landing + "/*", schema), table, ck)
    assert {r.k: r.v for r in out.collect()} == {"a": "2", "b": "1"}
    assert table.run_number() == 2


# -------------------------------------------------------------- plan shape
def test_mart_plans_have_no_nested_loops_or_python(spark):
    from ledgerline.plans.inspect import forbidden_operators
    from ledgerline.plans.queries import models
    m = models(spark, "/root/testdata/sf0.001")
    for name in ["subscription_months", "mrr_by_month_plan", "mrr_running_sum", "churn_rates",
                 "customer_ltv"]:
        assert forbidden_operators(m.model(name)) == [], name


def test_dedup_limits_before_shuffle(spark):
    from ledgerline.operators.dedup import keep_first
    from ledgerline.plans.inspect import plan_text
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    text = plan_text(keep_first(df, "k", ["id"]))
    assert "Partial" in text and text.index("Partial") > text.index("Exchange")  # partial below shuffle


def test_pipeline_run(spark, tmp_dir):
    from ledgerline.operators.history import history_target
    from ledgerline.operators.quality import CheckFailed
    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.plans.pipeline import published, run
    from ledgerline.sources.testdata import TEST_AS_OF, raw_tables
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    early = {n: df.where(F.col("updated_at") < F.lit("1998-01-01").cast("timestamp")) for n, df in raw.items()}
    out, sync = tmp_dir + "/m", tmp_dir + "/sync"
    history = history_target(spark, tmp_dir + "/snap", "subscription_id", "updated_at")
    assert published(spark, out) == {}
    run(spark, early, TEST_AS_OF, out, snapshot_path=tmp_dir + "/snap", sync_root=sync)
    res = run(spark, raw, TEST_AS_OF, out, snapshot_path=tmp_dir + "/snap", sync_root=sync)
    assert res.checks.count() == 50                                    # 3 landing + 39 + 8
    assert res.checks.where("check_name LIKE 'unique_raw_%' AND status != 'pass'").count() == 0
    assert all(0 < r["loaded"] < r["rows"] for r in res.loads.values())
    full = run(spark, raw, TEST_AS_OF, tmp_dir + "/full")
    for name in ("stg_invoices", "customer_ltv"):                       # incremental = full
        a, b = spark.read.parquet(res.models[name]), spark.read.parquet(full.models[name])
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
    n = history.read().count()
    assert n == spark.read.parquet(res.models["stg_subscriptions"]).count()
    with pytest.raises(CheckFailed):                                    # the test data fails error checks
        run(spark, raw, TEST_AS_OF, out, snapshot_path=tmp_dir + "/snap", fail_on_error=True)
    assert published(spark, out) == res.models and history.read().count() == n
    assert ParquetTarget(spark, sync + "/typed_invoices", "_row_id", "updated_at").run_number() == 2


def test_typed_invoices_keep_null_and_repeated_ids(spark, tmp_dir):
    from ledgerline.operators.staging import type_invoices
    from ledgerline.plans.pipeline import staged_invoices
    from ledgerline.sources.raw import raw_schema

    def landed(*items):
        return spark.createDataFrame([(n, i, "s1", f"2024-01-{d:02d}", amount, "EUR", "paid", TS(2024, 1, d))
                                      for n, i, amount, d in items], raw_schema("invoices", with_meta=True))
    first = [(1, None, "10", 1), (2, None, "10", 1), (3, "a", "20", 2), (4, "a", "30", 2), (5, "b", "40", 2)]
    # row 3 changes; two more rows come without an id, one repeats an id
    both = [r for r in first if r[0] != 3] + [(3, "a", "25", 3), (6, None, "50", 3), (7, None, "50", 3), (8, "b", "60", 4)]
    for items in (first, both):
        got, want = staged_invoices(spark, landed(*items), tmp_dir), type_invoices(landed(*items))
        assert got.count() == len(items) and got.select(want.columns).exceptAll(want).isEmpty()


def test_history_survives_a_failed_run(spark, tmp_dir):
    from ledgerline.operators.history import apply_snapshot, history_target
    table = history_target(spark, tmp_dir + "/h", "k", "ts")

    def state():
        return sorted((r.k, r.v, r.ts.day, r.valid_to.day if r.valid_to else None) for r in table.read().collect())

    def snap(*items):
        return spark.createDataFrame([(k, v, TS(2024, 1, d)) for k, v, d in items], "k string, v string, ts timestamp")
    assert table.read() is None
    apply_snapshot(table, snap(("a", "1", 1), ("b", "1", 1)))
    before = state()
    put, table.state.put = table.state.put, None                        # dies after the write, before the commit
    with pytest.raises(TypeError):
        apply_snapshot(table, snap(("a", "9", 9)))
    table.state.put = put
    assert state() == before
    apply_snapshot(table, snap(("a", "2", 2), ("c", "1", 2)))
    apply_snapshot(table, snap(("a", "3", 3), ("b", "0", 1)))
    apply_snapshot(table, snap(("b", "4", 4)))
    assert state() == [("a", "1", 1, 2), ("a", "2", 2, 3), ("a", "3", 3, None), ("b", "1", 1, 4), ("b", "4", 4, None),
                       ("c", "1", 2, None)]


def test_price_history_has_closed_versions(spark):
    from ledgerline.plans.queries import subscription_history
    assert subscription_history(spark, "/root/testdata/sf0.001").where("valid_to IS NOT NULL").count() > 0


def test_untyped_csv_landing(spark, tmp_dir):
    from ledgerline.sources.raw import land, read_untyped_csv
    path = os.path.join(tmp_dir, "subs.csv")
    with open(path, "w") as f:
        f.write("subscription_id,customer_id,plan_name,monthly_price,start_date,end_date,status\n"
                "S1,C1,starter,-99.00,2024-01-05,,ACTIVE\n"
                "S1,C1,starter,-99.00,2024-01-05,,ACTIVE\n"
                "S2,C2,growth,29.50,not-a-date,2024-02-01,paused\n")
    df = land(read_untyped_csv(spark, path, "subscriptions"), "subscriptions")
    rows = df.orderBy("subscription_id", "_row_id").collect()
    assert all(isinstance(r.monthly_price, str) for r in rows)          # no inference
    assert rows[0].monthly_price == "-99.00"
    assert rows[0]._row_id != rows[1]._row_id                           # exact repeats stay distinct
    assert rows[2].updated_at == TS(2024, 1, 1)                         # unparseable → fallback
    again = land(read_untyped_csv(spark, path, "subscriptions"), "subscriptions")
    assert sorted(r._row_id for r in again.collect()) == sorted(r._row_id for r in rows)  # stable


def test_load_report_counts_rows(spark, tmp_dir):
    from ledgerline.operators.targets import ParquetTarget
    t = ParquetTarget(spark, os.path.join(tmp_dir, "t"), "k", "ts")
    rep = t.load(_ev(spark, [("a", "1", TS(2024, 1, 1)), ("b", "1", TS(2024, 1, 2)),
                             ("poison", "1", TS(2031, 1, 1))]), run_ts=TS(2024, 6, 1))
    assert rep["rows"] == 2 and rep["quarantined"] == 1 and rep["watermark"] == TS(2024, 1, 2)


def test_present_orders_ltv(spark):
    from ledgerline.plans.models import present
    df = spark.createDataFrame([("C2", Decimal("5.00")), ("C1", Decimal("5.00")), ("C3", Decimal("9.00"))],
                               "customer_id string, ltv decimal(38,2)")
    assert [r.customer_id for r in present(df, "customer_ltv").collect()] == ["C3", "C1", "C2"]


def test_row_ids_for_hot_copy_groups(spark):
    from ledgerline.sources.raw import add_row_id
    rows = [("x", "1")] * 25 + [("y", "2")] * 3 + [("z", "3")]
    df = spark.createDataFrame(rows, "a string, b string")
    ids = add_row_id(df, ["a", "b"])
    got = ids.collect()
    assert len(got) == 29 and len({r._row_id for r in got}) == 29
    assert sorted((r.a, r.b) for r in got) == sorted(rows)
    again = {r._row_id for r in add_row_id(df.repartition(3), ["a", "b"]).collect()}
    assert again == {r._row_id for r in got}                     # stable across re-reads


def test_watermark_filter_reaches_the_scan(spark, tmp_dir):
    from ledgerline.operators.incremental import incremental_extract
    from ledgerline.plans.inspect import plan_text
    path = os.path.join(tmp_dir, "landing")
    _ev(spark, [("a", "1", TS(2024, 1, 1)), ("b", "1", TS(2024, 1, 5))]).write.parquet(path)
    df = incremental_extract(spark.read.parquet(path), "ts", TS(2024, 1, 3))
    text = plan_text(df)
    assert "PushedFilters" in text and "GreaterThanOrEqual(ts" in text
    assert [r.k for r in df.collect()] == ["b"]


def test_stream_sync_takes_late_and_repeated_rows(spark, tmp_dir):
    from ledgerline.operators.targets import ParquetTarget
    from ledgerline.streaming.sync import file_stream, sync_available
    landing = os.path.join(tmp_dir, "landing")
    batches = [[("a", "3", TS(2024, 3, 1)), ("b", "1", TS(2024, 2, 1))], [("a", "2", TS(2024, 1, 1))],       # late
               [("a", "3", TS(2024, 3, 1)), ("b", "2", TS(2024, 2, 2)), ("b", "1", TS(2024, 2, 1))]]         # repeated
    for k, rows in enumerate(batches):
        _ev(spark, rows).write.parquet(f"{landing}/f{k}")
    table = ParquetTarget(spark, os.path.join(tmp_dir, "t"), "k", "ts")
    stream = file_stream(spark, landing + "/*", spark.read.parquet(landing + "/f1").schema, max_files_per_trigger=1)
    out = sync_available(stream, table, os.path.join(tmp_dir, "ck"))
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", "3"), ("b", "2")]


def test_mrr_scan_reads_only_needed_columns(spark):
    from ledgerline.plans.inspect import plan_text
    from ledgerline.plans.queries import QUERIES
    text = plan_text(QUERIES["mrr_by_month_plan"](spark, "/root/testdata/sf0.001"))
    schemas = [l for l in text.splitlines() if l.startswith("ReadSchema")]
    assert schemas and not any("o_custkey" in l or "l_extendedprice" in l for l in schemas)


def test_scale_conf_sizes_partitions():
    from ledgerline.session import scale_conf
    big = scale_conf(100 * 2 ** 40)
    assert big["spark.sql.shuffle.partitions"] == "409600"
    assert scale_conf(10 * 2 ** 30)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(1 * 2 ** 40)["spark.sql.shuffle.partitions"] == "4096"


def test_existence_flag_spreads_null_keys(spark):
    from ledgerline.operators.existence import existence_flag
    df = spark.createDataFrame([(i, None if i % 3 else f"k{i % 7}") for i in range(300)], "id int, k string")
    ref = spark.createDataFrame([("k0",), ("k3",), ("k3",), (None,)], "k string")
    out = existence_flag(df, "k", ref, "k", "hit")
    rows = out.collect()
    assert len(rows) == 300 and out.columns == ["id", "k", "hit"]
    assert all(r.hit == (r.k in ("k0", "k3")) for r in rows)
    # With a shuffle join forced, NULL-key rows land in several partitions, not one.
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1" if "Threshold" in k else "false")
        shuffled = existence_flag(df, "k", ref, "k", "hit")
        parts = (shuffled.where(F.col("k").isNull()).select(F.spark_partition_id().alias("p"))
                 .distinct().count())
        assert parts > 1
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_no_checks_gives_empty_result(spark):
    res = run_checks(spark, [], lambda n: None, dt.date(2024, 1, 1))
    assert res.count() == 0 and res.columns[-1] == "status"
