"""The table stores never lose rows: unreadable files, NULL and odd partition
values, commit keys, timeouts, late rows, content ids."""

import datetime as dt
import glob
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.incremental import upsert
from ledgerline.operators.schema_sync import LossyChange, wider
from ledgerline.operators.targets import BUCKET, ParquetTarget, merge_into, takes_merge
from ledgerline.session import read_if_exists, scratch_dir
from ledgerline.sources.raw import add_row_id, land
from ledgerline.streaming.sync import file_stream, sync_available

T = dt.datetime
SCHEMA = "k string, v string, ts timestamp"


def rows(spark, *items):
    return spark.createDataFrame([(k, v, T(2024, 1, day)) for k, v, day in items], SCHEMA)


def table(spark, tmp_dir, **kw):
    return ParquetTarget(spark, os.path.join(tmp_dir, "t"), "k", "ts", **kw)


def state(t):
    return sorted(((r.k, r.v) for r in t.read().collect()), key=str)


def test_unreadable_target_is_an_error(spark, tmp_dir):
    t = table(spark, tmp_dir, buckets=1)
    t.apply(rows(spark, *[(f"k{i}", "1", 1) for i in range(9)]))
    victim = glob.glob(os.path.join(tmp_dir, "t", "data", f"{BUCKET}=*", "*.parquet"))[0]
    with open(victim, "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):
        t.apply(rows(spark, ("new", "1", 2)))
    assert os.path.exists(victim)
    assert read_if_exists(spark, os.path.join(tmp_dir, "nowhere")) is None


def test_a_null_key_is_one_key_and_no_row_is_lost(spark, tmp_dir):
    t = table(spark, tmp_dir)
    t.apply(rows(spark, ("a", "1", 1), (None, "1", 1), ("x/y:z=%", "1", 1)))
    t.apply(rows(spark, (None, "2", 2), (None, "1", 1), ("d", "1", 2)))
    assert state(t) == sorted([("a", "1"), (None, "2"), ("d", "1"), ("x/y:z=%", "1")], key=str)


def test_a_merge_touches_the_buckets_of_its_keys_only(spark, tmp_dir):
    t = table(spark, tmp_dir, buckets=8)
    t.apply(rows(spark, *[(f"k{i}", "1", 1) for i in range(60)]))

    def files():
        return {f for f in glob.glob(os.path.join(tmp_dir, "t", "data", "*", "*.parquet"))}
    before = files()
    report = t.apply(rows(spark, ("k3", "2", 2)))
    gone = {os.path.dirname(f) for f in before - files()}
    assert len(gone) == 1 and report["rows"] == 60 and report["inserted"] == 0
    assert state(t) == sorted([(f"k{i}", "2" if i == 3 else "1") for i in range(60)])
    assert not glob.glob(os.path.join(tmp_dir, "t", "_batch*")) and not glob.glob(os.path.join(tmp_dir, "t", "_merged*"))


def test_a_run_that_dies_while_files_are_replaced_is_finished_by_the_next(spark, tmp_dir):
    t = table(spark, tmp_dir, buckets=4)
    t.apply(rows(spark, *[(f"k{i}", "1", 1) for i in range(10)]))
    row, info = t._settled()
    t._settled = lambda: (row, info)                                    # dies once the merge is written and committed
    t.apply(rows(spark, ("k1", "2", 2), ("new", "2", 2)))
    again = table(spark, tmp_dir, buckets=4)
    pending = json.loads(again.state.get("table")["info"])["pending"]
    for folder in glob.glob(os.path.join(pending, f"{BUCKET}=*")):      # the replacement had begun
        shutil.rmtree(os.path.join(tmp_dir, "t", "data", os.path.basename(folder)), ignore_errors=True)
    assert state(again) == sorted([(f"k{i}", "2" if i == 1 else "1") for i in range(10)] + [("new", "2")])
    assert again.watermark() == T(2024, 1, 2) and not os.path.exists(pending)
    assert again.apply(rows(spark, ("k1", "3", 3)))["rows"] == 11


def test_the_same_batch_again_changes_nothing(spark, tmp_dir):
    t = table(spark, tmp_dir)
    assert t.apply(rows(spark, ("a", "1", 1)), 0, query="one")["inserted"] == 1
    assert t.apply(rows(spark, ("a", "1", 1)), 0, query="one")["inserted"] == 0
    t.apply(rows(spark, ("a", "9", 9), ("b", "1", 1)), 1)
    t.apply(rows(spark, ("a", "1", 1)), 0)                              # late
    assert state(t) == [("a", "9"), ("b", "1")]
    assert t.apply(rows(spark).limit(0)) is None


def test_sync_timeout_raises_and_the_next_call_goes_on(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    for i in range(6):
        rows(spark, (f"k{i}", "1", 1)).write.parquet(f"{landing}/f{i}")
    t = table(spark, tmp_dir)
    stream = file_stream(spark, landing + "/*", spark.read.parquet(landing + "/f0").schema, max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        sync_available(stream, t, os.path.join(tmp_dir, "ck"), timeout_s=0.05)
    out = sync_available(stream, t, os.path.join(tmp_dir, "ck"))
    assert sorted(r.k for r in out.collect()) == [f"k{i}" for i in range(6)]


def test_rows_that_arrive_during_a_load_wait_for_the_next(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    rows(spark, ("a", "1", 1)).write.parquet(landing)
    t = table(spark, tmp_dir)
    written = t._written

    def slow(df, name, *a, **kw):
        out = written(df, name, *a, **kw)
        if name == "batch":
            rows(spark, ("late", "1", 2), ("later", "1", 3)).write.mode("append").parquet(landing)
        return out
    t._written = slow
    report = t.load(spark.read.parquet(landing))
    assert report["watermark"] == T(2024, 1, 1) and report["loaded"] == report["rows"] == 1
    t._written = written
    report = t.load(spark.read.parquet(landing))
    assert report["rows"] == 3 and report["watermark"] == T(2024, 1, 3)


def test_counts_come_from_the_writes(spark, tmp_dir):
    """Rows loaded, held, inserted: one observed write of the batch and one of the merge, no count job."""
    t = table(spark, tmp_dir)
    assert t.load(rows(spark, *[(f"k{i}", "1", 1) for i in range(3)]))["loaded"] == 3
    counted = []
    from pyspark.sql import DataFrame as Sql
    try:
        real, Sql.count = type(rows(spark)).count, lambda self: counted.append(1)
        report = t.load(rows(spark, ("k0", "2", 2), ("k7", "1", 2), ("future", "1", 30)), run_ts=T(2024, 1, 10))
    finally:
        Sql.count = real
    assert not counted
    assert (report["loaded"], report["rows"], report["quarantined"], report["inserted"]) == (2, 4, 1, 1)
    assert report["watermark"] == T(2024, 1, 2)


def test_quarantine_holds_releases_and_clamps(spark, tmp_dir):
    t = table(spark, tmp_dir)

    def held():
        return sorted((r.k, r.v, r.state, r.held_at.day, r.settled_at.day if r.settled_at else None) for r in t.quarantine().collect())
    source = [("a", "1", 1), ("soon", "1", 12), ("fixed", "1", 25), ("far", "1", 30)]
    t.load(rows(spark, *source), run_ts=T(2024, 1, 10))
    t.load(rows(spark, *source), run_ts=T(2024, 1, 10))                 # the same rows again: no second row a key
    assert held() == [("far", "1", "held", 10, None), ("fixed", "1", "held", 10, None), ("soon", "1", "held", 10, None)]
    source[2] = ("fixed", "2", 11)                                      # corrected at the source
    report = t.load(rows(spark, *source), run_ts=T(2024, 1, 15))
    assert report["quarantined"] == 1 and state(t) == [("a", "1"), ("fixed", "2"), ("soon", "1")]
    assert held() == [("far", "1", "held", 10, None), ("fixed", "1", "released", 10, 15), ("soon", "1", "released", 10, 15)]
    t.load(rows(spark, *source), run_ts=T(2024, 1, 16), clamp=True)
    assert held()[0] == ("far", "1", "clamped", 10, 16)
    assert {r.k: r.ts.day for r in t.read().collect()}["far"] == 16 and t.watermark() == T(2024, 1, 16)
    gone = table(spark, tmp_dir + "x")                                  # a held row comes though the source lost it
    gone.load(rows(spark, ("a", "1", 1), ("later", "1", 12)), run_ts=T(2024, 1, 10))
    gone.load(rows(spark, ("a", "1", 1)), run_ts=T(2024, 1, 20))
    assert state(gone) == [("a", "1"), ("later", "1")]


def test_types_widen_and_lossy_changes_are_refused(spark, tmp_dir):
    from pyspark.sql import types as Q
    assert wider(Q.IntegerType(), Q.LongType()) == Q.LongType() == wider(Q.LongType(), Q.ShortType())
    assert wider(Q.DecimalType(10, 2), Q.DecimalType(8, 4)) == Q.DecimalType(12, 4)
    assert wider(Q.LongType(), Q.DecimalType(10, 2)) == Q.DecimalType(21, 2)
    assert wider(Q.IntegerType(), Q.DoubleType()) == Q.DoubleType() and wider(Q.DateType(), Q.TimestampNTZType()) == Q.TimestampNTZType()
    for pair in ((Q.LongType(), Q.DoubleType()), (Q.StringType(), Q.IntegerType()), (Q.DecimalType(38, 0), Q.DecimalType(38, 10)),
                 (Q.BooleanType(), Q.IntegerType())):
        assert wider(*pair) is None and wider(*reversed(pair)) is None
    t = ParquetTarget(spark, os.path.join(tmp_dir, "w"), "k", "ts")

    def frame(schema, *items):
        return spark.createDataFrame([(*i, T(2024, 1, 1)) for i in items], schema + ", ts timestamp")
    t.apply(frame("k int, n int, gone string", (1, 10, "x"), (2, 20, "y")))
    t.apply(frame("k long, n long, added double", (2, 1 << 40, 1.5), (3, 30, None)))
    t.apply(frame("k int, n int, added float", (1, 11, 2.5)))            # narrower again: stored types stay
    assert [f.dataType.simpleString() for f in t.read().drop("ts").schema] == ["bigint", "bigint", "double"]
    assert sorted((r.k, r.n, r.added) for r in t.read().collect()) == [(1, 11, 2.5), (2, 1 << 40, 1.5), (3, 30, None)]
    with pytest.raises(LossyChange, match="column n"):
        t.apply(frame("k long, n string, added double", (4, "x", 0.0)))
    assert t.read().count() == 3


def test_merge_is_left_to_the_catalog(spark, tmp_dir):
    """This session's catalog has plain Parquet tables only: the planner says so and MERGE raises Spark's error."""
    name = "merge_target_" + os.path.basename(tmp_dir).replace("-", "_")
    batch = rows(spark, ("a", "1", 1))
    assert not takes_merge(spark, name)
    spark.sql(f"CREATE TABLE {name} ({SCHEMA}) USING parquet LOCATION '{tmp_dir}/cat'")
    try:
        assert not takes_merge(spark, name)
        with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
            merge_into(batch, name, ["k"], "ts")
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_history_of_a_feed_equals_snapshot_runs(spark, tmp_dir):
    from ledgerline.operators.history import apply_snapshot, history_from_feed, history_target
    rng = random.Random(5)
    items = sorted({(rng.choice("abcd"), d): rng.choice("xyz") for d in rng.choices(range(1, 20), k=50)}.items(), key=lambda x: x[0][1])
    feed = rows(spark, *[(k, v, d) for (k, d), v in items])
    t = history_target(spark, os.path.join(tmp_dir, "h"), "k", "ts")
    for day in sorted({d for (_, d), _ in items}):
        apply_snapshot(t, rows(spark, *[(k, v, d) for (k, d), v in items if d == day]))
    cols = ["k", "v", "ts", "valid_from", "valid_to", "version_id"]
    whole = history_from_feed(feed, "k", "ts")
    assert sorted(map(str, whole.select(*cols).collect())) == sorted(map(str, t.read().select(*cols).collect()))
    islands = history_from_feed(feed, "k", "ts", ["v"])
    runs = {}
    for (k, d), v in items:
        if not runs.get(k) or runs[k][-1][0] != v:
            runs.setdefault(k, []).append((v, d))
    want = sorted((k, v, d, r[i + 1][1] if i + 1 < len(r) else None) for k, r in runs.items() for i, (v, d) in enumerate(r))
    assert sorted((r.k, r.v, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in islands.collect()) == want
    plan = islands._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_month_sweeps_equal_counting(spark):
    from decimal import Decimal

    from ledgerline.operators.history import mrr_as_known, mrr_at_month_starts
    rng = random.Random(8)
    day = lambda: dt.date(2023, rng.randrange(1, 13), rng.choice([1, 1, 15, 28]))
    versions = []
    for _ in range(60):
        a, b, s, e = sorted([day(), day()]) + sorted([day(), day()])
        versions.append((rng.choice("pq"), None if rng.random() < .2 else Decimal(rng.randrange(1, 99)), s,
                         None if rng.random() < .4 else e, T(a.year, a.month, a.day),
                         None if rng.random() < .4 else T(b.year, b.month, b.day)))
    h = spark.createDataFrame(versions, "plan_name string, monthly_price decimal(18,2), start_date date, end_date date, "
                                        "valid_from timestamp, valid_to timestamp")
    months = [dt.date(2023, m, 1) for m in range(1, 13)]

    def total(keep):
        out = {}
        for v in versions:
            for key in keep(v):
                n, mrr = out.get((*key, v[0]), (0, None))
                out[(*key, v[0])] = n + 1, mrr if v[1] is None else (mrr or 0) + v[1]
        return out

    def valid(v, k):
        t = T(k.year, k.month, 1)
        return v[4] <= t and (v[5] is None or v[5] > t)
    got = {(r.month_start, r.plan_name): (r.active_subscriptions, r.mrr) for r in mrr_at_month_starts(h, months[-1]).collect()}
    assert got == total(lambda v: [(m,) for m in months if valid(v, m) and (v[3] is None or v[3] >= m)])
    got = {(r.known_at, r.month_start, r.plan_name): (r.active_subscriptions, r.mrr) for r in mrr_as_known(h, months[-1]).collect()}
    assert got == total(lambda v: [(k, m) for k in months if valid(v, k) for m in months
                                   if m <= k and v[2].replace(day=1) <= m and (v[3] is None or v[3].replace(day=1) >= m)])


def test_content_ids_mark_nulls_and_are_no_merge_key(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", None), ("", "x"), (None, None)], "a string, b string")
    ids = [r._row_id for r in add_row_id(df, ["a", "b"]).collect()]
    assert len(set(ids)) == 5 and all(len(i) == 64 for i in ids)
    raw = spark.createDataFrame([("C1", "n", "e", "DE", "2024-01-01")],
                                "customer_id string, customer_name string, email string, country string, created_at string")
    landed = land(raw, "customers")
    with pytest.raises(ValueError, match="content id"):
        upsert(landed, landed, "_row_id", "updated_at")


def test_dated_rates_stay_open_and_rates_may_be_large(spark):
    from decimal import Decimal

    from ledgerline.functions.columns import round_ratio
    from ledgerline.functions.fx import convert_with_dated_rates
    rates = spark.createDataFrame([("SEK", dt.date(2024, 1, 10), Decimal("0.09")), ("SEK", dt.date(2024, 3, 5), Decimal("0.1"))],
                                  "currency string, valid_from date, rate_to_eur decimal(18,6)")
    days = [dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 3, 4), dt.date(2024, 3, 5), dt.date(2093, 7, 1)]
    facts = spark.createDataFrame([(Decimal("100.00"), "SEK", d) for d in days], "amount decimal(18,2), currency string, d date")
    got = {r.d: r.amount_eur for r in convert_with_dated_rates(facts, "amount", "currency", "d", rates).collect()}
    assert [got[d] for d in days] == [None, Decimal("9.00"), Decimal("9.00"), Decimal("10.00"), Decimal("10.00")]
    big = spark.createDataFrame([(Decimal("20000.00"), Decimal("0.01"))], "a decimal(38,2), b decimal(38,2)")
    assert big.select(round_ratio(F.col("a"), F.col("b"), 4, 2, 2).alias("r")).first().r == Decimal("2000000.0000")


def test_scratch_needs_a_shared_folder():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://elsewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_a_written_merge_is_moved_not_written_again(spark, tmp_dir):
    t = table(spark, tmp_dir, buckets=4)
    written, put = [], t.state.put

    def noted(*a, pending=None, **kw):
        if pending:
            written.append({os.path.relpath(f, pending) for f in glob.glob(os.path.join(pending, f"{BUCKET}=*", "*.parquet"))})
        put(*a, pending=pending, **kw)
    t.state.put = noted
    t.load(rows(spark, *[(f"k{i}", "1", 1) for i in range(20)]))
    stored_files = {os.path.relpath(f, t.data) for f in glob.glob(os.path.join(t.data, f"{BUCKET}=*", "*.parquet"))}
    assert stored_files == written[0]
    t.load(rows(spark, ("k3", "2", 2), ("k3", "3", 3), ("new", "1", 2)))
    stored_files = {os.path.relpath(f, t.data) for f in glob.glob(os.path.join(t.data, f"{BUCKET}=*", "*.parquet"))}
    assert written[1] and written[1] <= stored_files
    assert dict(state(t))["k3"] == "3" and len(state(t)) == 21


def test_quarantine_is_settled_in_one_write(spark, tmp_dir, monkeypatch):
    names, written = [], ParquetTarget._written
    monkeypatch.setattr(ParquetTarget, "_written", lambda self, df, name, *a, **kw: names.append(name) or written(self, df, name, *a, **kw))
    t = table(spark, tmp_dir)
    source = [("a", "1", 1), ("a", "2", 1), (None, "1", 12), (None, "2", 13), ("x", "1", 14), ("far", "1", 30)]
    t.load(rows(spark, *source), run_ts=T(2024, 1, 10), tiebreak=["v"])
    names.clear()
    t.load(rows(spark, *source), run_ts=T(2024, 1, 20), tiebreak=["v"])
    assert names == ["batch", "merged", "merged"]                       # the batch, the table, the quarantine
    assert state(t) == sorted([("a", "2"), (None, "2"), ("x", "1")], key=str)
    held = {(r.k, r.v, r.state, r.held_at.day, r.settled_at and r.settled_at.day) for r in t.quarantine().collect()}
    assert held == {(None, "2", "released", 10, 20), ("x", "1", "released", 10, 20), ("far", "1", "held", 10, None)}
