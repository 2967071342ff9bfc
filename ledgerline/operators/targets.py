"""Load targets: rows merged by key into a table.

Where the catalog's table takes it, ``merge_into`` is one ``MERGE``.  Elsewhere
``ParquetTarget`` keeps plain Parquet, partitioned by a hash of the key: a key
never changes its partition, so a merge reads and writes the partitions of its
batch's keys (dynamic partition overwrite) and none can end up empty.  Its
state is one row: watermark, schema, row count, and the folder of a merge that
has been written but not yet put in place; the next reader puts it in place (its
folders are moved, not written again), so a run that dies at any point loses nothing.

A merge is one shuffle: the table's rows of the touched partitions and the batch's rows
meet by slot, a finer hash of the key, and a window picks the row of each key.

What a load reports is observed on the writes themselves (``Observation``):
rows loaded, held and released and the new watermark on the write of the batch,
rows inserted on the write of the merge.  No job counts a second time.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.dedup import keep_latest
from ledgerline.operators.incremental import incremental_extract
from ledgerline.operators.schema_sync import synced_schema
from ledgerline.session import drop_path, move_path, path_exists, read_if_exists, subfolders

BUCKET = "_bucket"
SLOT = "_slot"
SLOTS = 32  # pieces of a bucket that are shuffled and sorted apart
STATE_SCHEMA = "watermark timestamp, run long, info string, resource string"


class LoadState:
    """One row a resource, in a partition of its own; a commit replaces it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def get(self, resource: str) -> Row | None:
        table = read_if_exists(self.spark, self.path, STATE_SCHEMA)
        return None if table is None else table.where(F.col("resource") == resource).first()

    def put(self, resource: str, watermark, run: int, **info) -> None:
        row = self.spark.createDataFrame([(watermark, run, json.dumps(info), resource)], STATE_SCHEMA)
        row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("resource").parquet(self.path)


def takes_merge(spark: SparkSession, table: str) -> bool:
    """Whether the catalog's table can be the target of MERGE (asked of the planner, nothing runs)."""
    if not spark.catalog.tableExists(table):
        return False
    plan = spark.sql(f"EXPLAIN MERGE INTO {table} t USING (SELECT * FROM {table} WHERE false) s ON false "
                     "WHEN NOT MATCHED THEN INSERT *").first()[0]
    return "Error occurred" not in plan


def merge_into(batch: DataFrame, table: str, keys: list[str], cursor: str, tiebreak: list[str] | None = None) -> None:
    """The batch's latest row per key replaces the table's, or is added.  A
    table that does not take MERGE raises Spark's own error."""
    latest = keep_latest(batch, keys, cursor, tiebreak).alias("s")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"{table}.{k}"))
    latest.mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


class ParquetTarget:
    """See the module.  A NULL key is one key.  ``bucket_on`` names the key columns
    that are hashed (all by default); ``buckets`` is fixed when the table begins."""

    RESOURCE = "table"

    def __init__(self, spark: SparkSession, root: str, keys: list[str] | str, cursor: str, buckets: int = 16,
                 bucket_on: list[str] | None = None):
        self.spark, self.root, self.cursor, self.buckets = spark, root, cursor, buckets
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.bucket_on = bucket_on or self.keys
        self.data = os.path.join(root, "data")
        self.state = LoadState(spark, os.path.join(root, "state"))

    # -------------------------------------------------------------- state

    def _settled(self) -> tuple[Row | None, dict]:
        """The state, after a written merge has been put in place."""
        row = self.state.get(self.RESOURCE)
        if row is None:
            return None, {}
        info = json.loads(row["info"])
        if info["pending"]:
            self._put_in_place(info["pending"], info["full"])
            info["pending"] = None
            self.state.put(self.RESOURCE, row["watermark"], row["run"], **info)
        return row, info

    def _put_in_place(self, pending: str, full: bool) -> None:
        """Move a written merge into the table: all of it, or its partitions.
        What a run that died has moved already is no longer under ``pending``."""
        if not path_exists(self.spark, pending):
            return
        if full:
            drop_path(self.spark, self.data)
            move_path(self.spark, pending, self.data)
            return
        for name in subfolders(self.spark, pending):
            drop_path(self.spark, os.path.join(self.data, name))
            move_path(self.spark, os.path.join(pending, name), os.path.join(self.data, name))
        drop_path(self.spark, pending)

    def _rows(self, info: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(info["schema"])).parquet(self.data)

    def read(self) -> DataFrame | None:
        """The table; None before the first load."""
        row, info = self._settled()
        return None if row is None else self._rows(info).drop(BUCKET)

    def watermark(self):
        row = self.state.get(self.RESOURCE)
        return row["watermark"] if row else None

    def run_number(self) -> int:
        row = self.state.get(self.RESOURCE)
        return row["run"] if row else 0

    # -------------------------------------------------------------- writes

    def _hash(self, schema: T.StructType, parts: int):
        """Hash of the key in the table's types."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in self.bucket_on]), F.lit(parts)).cast("int")

    def _bucket(self, buckets: int, schema: T.StructType):
        return self._hash(schema, buckets)

    def _by_slot(self, rows: DataFrame, schema: T.StructType, buckets: int):
        """Rows with bucket and slot, shuffled so that the rows of a key meet, and the window of a key."""
        placed = rows.withColumn(SLOT, self._hash(schema, buckets * SLOTS)).repartition(F.col(SLOT)) \
            .withColumn(BUCKET, F.col(SLOT) % F.lit(buckets))
        return placed, Window.partitionBy(BUCKET, SLOT, *self.keys)

    @staticmethod
    def _cast(df: DataFrame, schema: T.StructType, side: int) -> DataFrame:
        """``df`` in the schema's columns and types (NULL where it has none), and its side."""
        return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema], F.lit(side).alias("_side"))

    def _synced(self, info: dict, batch: T.StructType) -> tuple[T.StructType, bool]:
        if not info:
            return batch, True
        stored = T.StructType([f for f in T.StructType.fromJson(info["schema"]) if f.name != BUCKET])
        return synced_schema(stored, batch)

    def _written(self, df: DataFrame, name: str, drop: str | None = None, **metrics) -> tuple[DataFrame, str, dict]:
        """``df`` written under the root (less a column only its metrics need),
        the folder, and the metrics observed on that write."""
        path, seen = os.path.join(self.root, f"_{name}-{uuid.uuid4().hex[:12]}"), Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(seen, *[v.alias(k) for k, v in metrics.items()])
        df = df.drop(drop) if drop else df
        writer = df.write.partitionBy(BUCKET) if BUCKET in df.columns else df.write
        writer.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path, {**dict.fromkeys(metrics), **(seen.get or {})}

    def merge(self, batch: DataFrame, touched: list[int] | None = None, watermark=None, refresh: bool = False,
              newest_by: list[str] | None = None, tiebreak: list[str] | None = None) -> dict:
        """Merge a written batch.  Of a key's rows the batch's wins, unless the
        table's is newer by the cursor (then ``newest_by``); of several in the batch
        the newest, then the greatest by ``tiebreak``."""
        row, info = self._settled()
        refresh = refresh or row is None
        buckets = info.get("buckets", self.buckets)
        schema, changed = self._synced({} if refresh else info, batch.schema)
        rows = self._cast(batch, schema, 1)
        if not refresh:
            rows = self._cast(self._touched(info, schema, batch, None if changed else touched, changed), schema, 0).unionByName(rows)
        placed, key = self._by_slot(rows, schema, buckets)
        order = [F.col(x).desc_nulls_last() for x in (self.cursor, *(newest_by or []), "_side", *(tiebreak or []))]
        merged = placed.withColumn("_new", F.min("_side").over(key) == 1) \
            .withColumn("_rn", F.row_number().over(key.orderBy(*order))).where("_rn = 1")
        return self._commit(merged.select(*[F.col(f"`{c}`") for c in schema.names], "_new", BUCKET), row, info, buckets, changed,
                            watermark, refresh)

    def _touched(self, info: dict, schema: T.StructType, batch: DataFrame, touched: list[int] | None, every: bool) -> DataFrame:
        """The table's rows in the partitions of the batch's keys (with ``every``: all,
        as a new schema writes every file anew)."""
        if every:
            return self._rows(info).drop(BUCKET)
        if touched is None:
            buckets = info.get("buckets", self.buckets)
            touched = [r[0] for r in batch.select(self._bucket(buckets, schema)).distinct().collect()]  # at most ``buckets``
        return self._rows(info).where(F.col(BUCKET).isin(touched)).drop(BUCKET)

    def _commit(self, merged: DataFrame, row: Row | None, info: dict, buckets: int, changed: bool, watermark=None,
                refresh: bool = False) -> dict:
        """Write the merged partitions, record them with the new state, put them in place."""
        out, folder, seen = self._written(merged, "merged", drop="_new", rows=F.count(F.lit(1)), inserted=F.count_if(F.col("_new")))
        inserted, run = seen["inserted"] or 0, (row["run"] if row else 0) + 1
        rows = (seen["rows"] or 0) if changed else info["rows"] + inserted
        wm = max([w for w in (watermark, row["watermark"] if row and not refresh else None) if w], default=None)
        self.state.put(self.RESOURCE, wm, run, pending=folder, schema=json.loads(out.schema.json()), buckets=buckets, rows=rows,
                       full=changed)
        self._settled()
        return {"run": run, "inserted": inserted, "rows": rows, "watermark": wm}

    # -------------------------------------------------------------- loads

    def apply(self, batch: DataFrame, epoch: int | None = None, tiebreak: list[str] | None = None, query: str = "") -> dict | None:
        """Merge one batch (a streaming micro-batch).  A row older than the
        table's by cursor and tiebreak changes nothing, so batches that are
        delivered again or late rows are harmless."""
        latest = keep_latest(batch, self.keys, self.cursor, tiebreak)
        staged, folder, seen = self._written(latest, "batch", rows=F.count(F.lit(1)), wm=F.max(F.col(self.cursor).cast("timestamp")))
        out = self.merge(staged, watermark=seen["wm"], newest_by=tiebreak) if seen["rows"] else None
        drop_path(self.spark, folder)
        return out

    def load(self, source: DataFrame, full_refresh: bool = False, strict: bool = False, run_ts=None,
             tiebreak: list[str] | None = None, clamp: bool = False) -> dict:
        """One incremental (or full) run: rows at or after the watermark, and held
        rows whose time has come.  Rows with a cursor after ``run_ts`` are held in
        the quarantine, or, with ``clamp``, loaded with the cursor set to ``run_ts``."""
        row, info = self._settled()
        wm = None if full_refresh or row is None else row["watermark"]
        extract = incremental_extract(source, self.cursor, wm, strict)
        kind = source.schema[self.cursor].dataType
        future, quarantine = F.lit(False), None
        if run_ts is not None:
            limit = F.lit(run_ts).cast("timestamp")
            future = F.coalesce(F.col(self.cursor).cast("timestamp") > limit, F.lit(False))
            quarantine = self._quarantine().read()
            if quarantine is not None:
                due = quarantine.where((F.col("state") == "held") & (F.col(self.cursor).cast("timestamp") <= limit))
                extract = extract.unionByName(due.select(*[c for c in due.columns if c in extract.columns]),
                                              allowMissingColumns=True)
        bucket = self._bucket(info.get("buckets", self.buckets), self._synced({} if full_refresh else info, source.schema)[0])
        extract = extract.withColumn("_late", future).withColumn("_cursor", F.col(self.cursor))
        if clamp and run_ts is not None:
            extract = extract.withColumn(self.cursor, F.when(future, F.lit(run_ts).cast(kind)).otherwise(F.col(self.cursor)))
        accepted = F.lit(True) if clamp else ~F.col("_late")
        staged, folder, seen = self._written(
            extract, "batch", loaded=F.count_if(accepted), late=F.count_if(F.col("_late")),
            wm=F.max(F.when(accepted, F.col(self.cursor).cast("timestamp"))),
            touched=F.collect_set(F.when(accepted, bucket)))
        plain = [c for c in staged.columns if c not in ("_late", "_cursor")]
        report = self.merge(staged.where(accepted).select(*plain), seen["touched"] or [], seen["wm"], refresh=full_refresh,
                            tiebreak=tiebreak)
        if run_ts is not None and (seen["late"] or (quarantine is not None and not quarantine.where("state = 'held'").isEmpty())):
            self._settle_quarantine(staged, plain, accepted, run_ts, clamp, tiebreak)
        drop_path(self.spark, folder)
        return {**report, "loaded": seen["loaded"] or 0, "quarantined": 0 if clamp else seen["late"] or 0}

    # -------------------------------------------------------------- quarantine

    def _quarantine(self) -> ParquetTarget:
        return ParquetTarget(self.spark, os.path.join(self.root, "_quarantine"), self.keys, "_seen_at", self.buckets, self.bucket_on)

    def _settle_quarantine(self, staged: DataFrame, plain: list[str], accepted, run_ts, clamp: bool,
                           tiebreak: list[str] | None) -> None:
        """One row per key that was ever held: held (since), released or clamped (when).
        Its rows, the run's late rows and the keys that came in time meet in one shuffle."""
        target, now = self._quarantine(), F.lit(run_ts).cast("timestamp")
        late = staged.where("_late").withColumn(self.cursor, F.col("_cursor")).select(*plain) \
            .withColumn("held_at", now).withColumn("state", F.lit("clamped" if clamp else "held")) \
            .withColumn("settled_at", now if clamp else F.lit(None).cast("timestamp")).withColumn("_seen_at", now)
        row, info = target._settled()
        buckets = info.get("buckets", target.buckets)
        schema, changed = target._synced(info, late.schema)
        rows = self._cast(late, schema, 1)
        if row is not None:
            came = staged.where(accepted & ~F.col("_late")).select(*self.keys)
            rows = rows.unionByName(self._cast(target._touched(info, schema, staged, None, changed), schema, 0)) \
                .unionByName(self._cast(came, schema, 2))
        placed, key = target._by_slot(rows, schema, buckets)
        side, held = F.col("_side"), F.col("state") == "held"
        newer = (side == 0) & (F.col("_seen_at") > now)
        prefer = F.when(newer, 0).when(side == 1, 1).when(side == 0, 2).otherwise(3)
        order = [prefer, *[F.col(x).desc_nulls_last() for x in (self.cursor, *(tiebreak or []))]]
        seen = placed.withColumn("_new", F.min("_side").over(key) > 0) \
            .withColumn("_came", F.max(side == 2).over(key)) \
            .withColumn("_since", F.max(F.when((side == 0) & held, F.col("held_at"))).over(key)) \
            .withColumn("_rn", F.row_number().over(key.orderBy(*order))).where((F.col("_rn") == 1) & (side != 2))
        free = (side == 0) & held & F.col("_came") & ~newer
        settled = {"held_at": F.when(side == 1, F.coalesce("_since", "held_at")).otherwise(F.col("held_at")),
                   "state": F.when(free, F.lit("released")).otherwise(F.col("state")),
                   "settled_at": F.when(free, now).otherwise(F.col("settled_at")),
                   "_seen_at": F.when(free, now).otherwise(F.col("_seen_at"))}
        merged = seen.select(*[settled.get(x, F.col(f"`{x}`")).alias(x) for x in schema.names], "_new", BUCKET)
        target._commit(merged, row, info, buckets, changed)

    def quarantine(self) -> DataFrame | None:
        """Every key ever held, one row each: the row, ``state`` (held, released,
        clamped), ``held_at`` and ``settled_at``."""
        rows = self._quarantine().read()
        return None if rows is None else rows.drop("_seen_at")
