"""One callable for a scheduled run: sync → models, checked level by level →
history → publish.

Every run writes its models as Parquet into a folder of its own and reads them
back for their consumers, so each is computed once.  The checks of a level's
models run before anything reads them; a run that fails publishes nothing, and
readers go on with the last published one.  The caller schedules the run;
nothing here assumes a scheduler.
"""

from __future__ import annotations

import json
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.history import apply_snapshot, history_target
from ledgerline.operators.quality import raise_on_error, run_checks
from ledgerline.operators.staging import type_invoices
from ledgerline.operators.targets import LoadState, ParquetTarget
from ledgerline.plans.checks import column_checks, landing_checks, singular_checks
from ledgerline.plans.models import BillingModels
from ledgerline.sources.raw import RAW_KEY

# Build levels: every model after the models it reads; models of one level are
# independent and are built concurrently.
MODEL_LEVELS = [
    ["stg_customers", "stg_subscriptions", "stg_invoices"],
    ["effective_dates", "customer_revenue", "subscription_summary", "customer_ltv"],
    ["subscription_months", "mrr_by_month_plan", "churn_base"],
    ["churn_rates"],
]
MODEL_ORDER = [n for level in MODEL_LEVELS for n in level]


class _WrittenModels(BillingModels):
    """Models whose every build is written to Parquet and read back."""

    def __init__(self, spark: SparkSession, raw, as_of, out_dir: str, typed_invoices: DataFrame | None = None, **kw):
        super().__init__(raw, as_of, materialize=True, **kw)
        self.spark = spark
        self.out_dir = out_dir
        if typed_invoices is not None:
            self.typed_invoices = typed_invoices

    def _m(self, name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(self.out_dir, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def sync(spark: SparkSession, sources: dict[str, DataFrame], root: str, run_ts=None,
         full_refresh: bool = False) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """One sync of all raw resources into tables under ``root``, each with its own
    watermark: the landed tables, and per resource the load's report (rows
    loaded, quarantined, in the table).  Sources whose row id is a content id
    cannot be merged and need ``full_refresh`` after the first run."""
    tables = {name: ParquetTarget(spark, os.path.join(root, name), RAW_KEY, "updated_at") for name in sources}
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        reports = dict(zip(sources, pool.map(
            lambda name: tables[name].load(sources[name], full_refresh=full_refresh, run_ts=run_ts), sources)))
    return {name: table.read() for name, table in tables.items()}, reports


def staged_invoices(spark: SparkSession, landed: DataFrame, root: str, full_refresh: bool = False) -> DataFrame:
    """Typed invoices kept from run to run: only rows at or after the watermark
    are typed again.  The subscription flag is not stored, since a
    subscription may arrive after its invoices.  Merged on the landed row id,
    since invoice ids may be NULL or repeated; a table kept without it is
    built anew from the landed rows."""
    table = ParquetTarget(spark, os.path.join(root, "typed_invoices"), RAW_KEY, "updated_at")
    tie = ["invoice_date", "amount", "currency", "status", "subscription_id"]
    kept = table.read()
    full_refresh = full_refresh or (kept is not None and RAW_KEY not in kept.columns)
    table.load(type_invoices(landed), full_refresh=full_refresh, tiebreak=tie)
    return table.read()


@dataclass
class RunResult:
    models: dict[str, str]
    checks: DataFrame
    snapshot_path: str | None
    loads: dict[str, dict] = field(default_factory=dict)


def published(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Model name → folder of the last published run (empty before the first)."""
    row = LoadState(spark, os.path.join(out_dir, "_published")).get("run")
    return {} if row is None else {n: os.path.join(out_dir, json.loads(row["info"])["folder"], n) for n in MODEL_ORDER}


def run(spark: SparkSession, raw: dict[str, DataFrame], as_of, out_dir: str,
        snapshot_path: str | None = None, fail_on_error: bool = False, sync_root: str | None = None,
        run_ts=None, full_refresh: bool = False) -> RunResult:
    """Sync (with ``sync_root``; else ``raw`` is taken as landed), build and check
    every model level by level, update the subscription history, publish.
    With ``fail_on_error`` the run stops at the first level with a failed error
    check: the levels after it are not built and nothing is published."""
    loads, typed = {}, None
    if sync_root:
        raw, loads = sync(spark, raw, sync_root, run_ts, full_refresh)
        typed = staged_invoices(spark, raw["invoices"], sync_root, full_refresh)
    folder = f"run-{uuid.uuid4().hex[:12]}"
    m = _WrittenModels(spark, raw, as_of, os.path.join(out_dir, folder), typed)
    suite = landing_checks() + column_checks() + singular_checks()
    path = os.path.join(out_dir, folder, "_check_results")
    for i, level in enumerate(MODEL_LEVELS):
        m.build([level])
        due = [ch for ch in suite if ch.model in level or (i == 0 and ch.model.startswith("raw_"))]
        results = run_checks(spark, due, m.model, as_of).withColumn("as_of", F.lit(str(as_of)).cast("date"))
        results.withColumn("level", F.lit(i)).write.mode("append").parquet(path)
        if fail_on_error:
            raise_on_error(spark.read.parquet(path))
    if snapshot_path:
        apply_snapshot(history_target(spark, snapshot_path, "subscription_id", "updated_at"), m.stg_subscriptions)
    LoadState(spark, os.path.join(out_dir, "_published")).put("run", None, 0, folder=folder)
    return RunResult(models=published(spark, out_dir), checks=spark.read.parquet(path),
                     snapshot_path=snapshot_path, loads=loads)
