"""Type-2 history (timestamp strategy) and point-in-time reads.

A snapshot run compares each key's current version with the source row: if
the source's ``updated_at`` is *newer*, the current version is closed at that
time and the source row opens a new one; an older or equal ``updated_at``
changes nothing (so out-of-order and repeated runs are harmless).  Keys that
disappear from the source are not closed (no delete tracking).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.dedup import keep_latest
from ledgerline.operators.targets import ParquetTarget

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
VERSION_ID = "version_id"


@dataclass
class HistoryDelta:
    """Result of one run: rows closed by this run (append to the closed part)
    and the new current part (rewrite)."""
    closed_now: DataFrame
    current: DataFrame


def _open_versions(rows: DataFrame, keys: list[str], updated_at: str) -> DataFrame:
    return (rows.withColumn(VALID_FROM, F.col(updated_at))
            .withColumn(VALID_TO, F.lit(None).cast(rows.schema[updated_at].dataType))
            .withColumn(VERSION_ID, F.xxhash64(*[F.col(k) for k in keys], F.col(updated_at))))


def _stepped(current: DataFrame | None, snapshot: DataFrame, keys: list[str], updated_at: str,
             changes: bool = False) -> DataFrame:
    """The rows a run closes (``valid_to`` set) and all current ones, from one
    join; with ``changes`` only those it closes or opens."""
    rest = [c for c in snapshot.columns if c not in (*keys, updated_at)]
    snap = keep_latest(snapshot, keys, updated_at, rest)  # equal timestamps: decided by the whole row
    opened = _open_versions(snap, keys, updated_at)
    if current is None:
        return opened
    cols = current.columns
    met = (current.select(*keys, F.struct(*cols).alias("_cur"))
           .join(opened.select(*keys, F.struct(*cols).alias("_new")), keys, "full_outer"))
    cur, new = F.col("_cur"), F.col("_new")
    rows = (F.when(cur.isNull(), F.array(new))
            .when(new[updated_at] > cur[updated_at], F.array(cur.withField(VALID_TO, new[updated_at]), new))
            .otherwise(F.filter(F.array(cur), lambda _: F.lit(not changes))))
    return met.select(F.inline(rows)).select(*cols)


def scd2_step(current: DataFrame | None, snapshot: DataFrame, keys: list[str] | str,
              updated_at: str) -> HistoryDelta:
    """Apply one snapshot to the *current* versions only (one per key).

    Cost is O(keys + snapshot) per run: closed history is never re-read or
    rewritten.  If a snapshot carries several rows per key, only the latest
    is taken (chain intermediate versions by feeding them as separate runs).
    """
    rows = _stepped(current, snapshot, [keys] if isinstance(keys, str) else list(keys), updated_at)
    return HistoryDelta(closed_now=rows.where(F.col(VALID_TO).isNotNull()), current=rows.where(F.col(VALID_TO).isNull()))


def scd2_apply(history: DataFrame | None, snapshot: DataFrame, keys: list[str] | str,
               updated_at: str) -> DataFrame:
    """Whole-history form: closed history ∪ closed-now ∪ current."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if history is None:
        return _stepped(None, snapshot, keys, updated_at)
    return history.where(F.col(VALID_TO).isNotNull()).unionByName(
        _stepped(history.where(F.col(VALID_TO).isNull()), snapshot, keys, updated_at))


def history_target(spark: SparkSession, root: str, keys: list[str] | str, updated_at: str, buckets: int = 16) -> ParquetTarget:
    """A stored Type-2 history: one row a version, hashed by the business key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return ParquetTarget(spark, root, [*keys, VALID_FROM], updated_at, buckets, bucket_on=keys)


def apply_snapshot(target: ParquetTarget, snapshot: DataFrame) -> dict | None:
    """One snapshot run: only the versions it closes or opens are merged."""
    history = target.read()
    current = None if history is None else history.where(F.col(VALID_TO).isNull())
    return target.apply(_stepped(current, snapshot, target.bucket_on, target.cursor, changes=True))


def history_from_feed(feed: DataFrame, keys: list[str] | str, updated_at: str, state: list[str] | None = None) -> DataFrame:
    """The history of a whole change feed in one shuffle.

    Rows of a key follow each other by ``updated_at`` (of rows at the same time
    the greatest by all columns counts).  A row opens a version when its
    ``state`` columns differ from the row before (``lag``; without ``state``
    every row does, which equals one snapshot run after the other); the next
    version closes it (``lead``).  Rows without a time are ignored.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in feed.columns if c not in (*keys, updated_at)]
    known = feed.where(F.col(updated_at).isNotNull()).repartition(*keys)  # serves every window below
    rows = keep_latest(known, [*keys, updated_at], updated_at, rest)
    order = Window.partitionBy(*keys).orderBy(updated_at)
    if state is not None:
        before, now = F.lag(F.struct(*state)).over(order), F.struct(*state)
        first = F.row_number().over(order) == 1
        rows = rows.withColumn("_opens", first | ~now.eqNullSafe(before)).where("_opens").drop("_opens")
    return rows.withColumn(VALID_FROM, F.col(updated_at)).withColumn(VALID_TO, F.lead(updated_at).over(order)) \
        .withColumn(VERSION_ID, F.xxhash64(*[F.col(k) for k in keys], F.col(updated_at)))


def as_of(history: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts`` (valid_from <= ts < valid_to)."""
    t = F.lit(ts).cast(history.schema[VALID_FROM].dataType)
    return history.where((F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > t)))


def valid_periods(history: DataFrame, start, end, unit: str = "day") -> DataFrame:
    """One row per version per period start (``unit`` = day or month) at
    which the version is valid (valid_from <= P < valid_to), for P in
    [start, end], as column ``period_start``.

    Each version generates its own period range (no join against a calendar
    and no range predicate), so the work is proportional to the output.
    """
    fmt = "DAY" if unit == "day" else "MONTH"
    s = F.lit(str(start)).cast("date")
    e = F.lit(str(end)).cast("date")
    vf = F.col(VALID_FROM).cast("timestamp")
    vt = F.col(VALID_TO).cast("timestamp")

    def floor(ts):
        return F.date_trunc(fmt, ts).cast("date")

    def shift(d, n):
        return F.date_add(d, n) if unit == "day" else F.add_months(d, n)

    first = F.when(F.date_trunc(fmt, vf) == vf, floor(vf)).otherwise(shift(floor(vf), 1))
    last = (F.when(vt.isNull(), e)
            .when(F.date_trunc(fmt, vt) == vt, shift(floor(vt), -1))
            .otherwise(floor(vt)))
    lo = F.greatest(first, s)
    hi = F.least(last, e)
    step = F.expr("INTERVAL 1 DAY") if unit == "day" else F.expr("INTERVAL 1 MONTH")
    return (history.where(lo <= hi)
            .withColumn("period_start", F.explode(F.sequence(lo, hi, step))))


def carried_forward(feed: DataFrame, keys: list[str], updated_at: str, columns: list[str]) -> DataFrame:
    """Partial rows made whole: of rows of one key and time the greatest value
    of each column counts, and a NULL takes the key's last known value."""
    known = feed.where(F.col(updated_at).isNotNull()).repartition(*keys)
    rows = known.groupBy(*keys, updated_at).agg(*[F.max(c).alias(c) for c in columns])
    order = Window.partitionBy(*keys).orderBy(updated_at).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(*keys, updated_at, *[F.last(c, ignorenulls=True).over(order).alias(c) for c in columns])


def _month_at_or_after(ts: Column) -> Column:
    floor = F.trunc(ts, "MM")
    return F.when(floor.cast("timestamp") == ts, floor).otherwise(F.add_months(floor, 1))


def known_months(history: DataFrame) -> tuple[Column, Column]:
    """First and last month start at which a version is valid (last is NULL while it is open)."""
    vf, vt = (F.col(c).cast("timestamp") for c in (VALID_FROM, VALID_TO))
    return _month_at_or_after(vf), F.add_months(_month_at_or_after(vt), -1)


def _running(deltas: DataFrame, along: str, by: list[str], sums: list[str], last) -> DataFrame:
    """Running sums of signed deltas along a month axis, one row for every month
    from a step to the month before the next one (``last`` after the final step)."""
    order = Window.partitionBy(*by).orderBy(along)
    steps = deltas.groupBy(*by, along).agg(*[F.sum(c).alias(c) for c in sums])
    until = F.coalesce(F.add_months(F.lead(along).over(order), -1), F.lit(last).cast("date"))
    total = [F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in sums]
    return steps.select(*by, along, until.alias("_until"), *total).where(F.col(along) <= F.col("_until")) \
        .withColumn(along, F.explode(F.sequence(along, "_until", F.expr("INTERVAL 1 MONTH")))).drop("_until")


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where(F.col("n") > 0).select(
        *keys, F.when(F.col("priced") > 0, F.col("amount")).cast("decimal(38,2)").alias("mrr"),
        F.col("n").cast("long").alias("active_subscriptions"))


def _signed(price: str):
    p = F.col(price)
    return [(F.coalesce(p, F.lit(0)) * F.col("sign")).alias("amount"), F.col("sign").alias("n"),
            F.when(p.isNotNull(), F.col("sign")).otherwise(0).alias("priced")]


SUMS = ["amount", "n", "priced"]


def mrr_at_month_starts(history: DataFrame, last_month, price: str = "monthly_price") -> DataFrame:
    """MRR and subscriptions by plan at each month start, from the version valid
    then, while it has not ended.  A version adds its price at its first month
    and takes it off after its last; these steps are summed before anything
    else, so the cost grows with versions and not with their months."""
    first, until = known_months(history)
    rows = history.select("plan_name", F.col(price).alias("price"), first.alias("lo"),
                          F.least(until, F.trunc("end_date", "MM"), F.lit(last_month).cast("date")).alias("hi")) \
        .where(F.col("lo") <= F.col("hi"))
    steps = F.array(F.struct(F.col("lo").alias("month_start"), F.lit(1).alias("sign")),
                    F.struct(F.add_months("hi", 1).alias("month_start"), F.lit(-1).alias("sign")))
    deltas = rows.select("plan_name", "price", F.explode(steps).alias("s")).select("plan_name", "price", "s.*") \
        .select("plan_name", "month_start", *_signed("price"))
    return _totals(_running(deltas, "month_start", ["plan_name"], SUMS, last_month), ["month_start", "plan_name"])


def mrr_as_known(history: DataFrame, last_month, price: str = "monthly_price") -> DataFrame:
    """MRR of each month as known at each later month start (how it was restated).

    A version counts in the months from its start to its end, at the month
    starts it is valid at: a rectangle of (known at, month).  Its four signed
    corners are summed per corner, then along the months it was known, then
    along the months it counts in, so cost grows with versions, plus plans by
    months squared."""
    last = F.lit(last_month).cast("date")
    first, until = known_months(history)
    rows = history.select("plan_name", F.col(price).alias("price"), first.alias("k_lo"), F.least(until, last).alias("k_hi"),
                          F.trunc("start_date", "MM").alias("m_lo"), F.least(F.trunc("end_date", "MM"), last).alias("m_hi")) \
        .where((F.col("k_lo") <= F.col("k_hi")) & (F.col("m_lo") <= F.col("m_hi")))
    corners = F.array(*[F.struct(k.alias("known_at"), m.alias("month_start"), F.lit(a * b).alias("sign"))
                        for k, a in ((F.col("k_lo"), 1), (F.add_months("k_hi", 1), -1))
                        for m, b in ((F.col("m_lo"), 1), (F.add_months("m_hi", 1), -1))])
    deltas = rows.select("plan_name", "price", F.explode(corners).alias("s")).select("plan_name", "price", "s.*") \
        .select("plan_name", "known_at", "month_start", *_signed("price"))
    by_known = _running(deltas, "known_at", ["plan_name", "month_start"], SUMS, last_month)
    both = _running(by_known, "month_start", ["plan_name", "known_at"], SUMS, last_month)
    return _totals(both.where(F.col("month_start") <= F.col("known_at")), ["known_at", "month_start", "plan_name"])
