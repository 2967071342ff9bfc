"""The raw layer: every business column is text, plus a surrogate row id
and a load cursor.  Nothing is cleaned here — cleaning is what the staging
jobs do, visibly."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import parse_cursor

# Business columns of the three raw billing tables, in source order.
RAW_COLUMNS = {
    "customers": ["customer_id", "customer_name", "email", "country", "created_at"],
    "subscriptions": ["subscription_id", "customer_id", "plan_name", "monthly_price",
                      "start_date", "end_date", "status"],
    "invoices": ["invoice_id", "subscription_id", "invoice_date", "amount", "currency",
                 "status"],
}

# The business column each table's load cursor is derived from.
CURSOR_SOURCE = {"customers": "created_at", "subscriptions": "start_date",
                 "invoices": "invoice_date"}

# Merge key of every raw table: the surrogate, never the business key, so that
# planted duplicates survive landing for the staging layer to see.
RAW_KEY = "_row_id"


def raw_schema(table: str, with_meta: bool = False) -> T.StructType:
    """All-string schema for a raw table (optionally with ``_row_id`` and
    ``updated_at``)."""
    fields = [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[table]]
    if with_meta:
        fields = ([T.StructField(RAW_KEY, T.LongType(), False)] + fields
                  + [T.StructField("updated_at", T.TimestampType(), False)])
    return T.StructType(fields)


def read_untyped_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a CSV export with zero type inference: every column is text.

    Spark reads an empty field as NULL; the cleaning helpers treat NULL and
    ``''`` alike, so either representation of a blank is fine downstream.
    """
    return (spark.read.schema(raw_schema(table)).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


def add_updated_at(df: DataFrame, source_col: str) -> DataFrame:
    """Cursor := parsed business timestamp; unparseable → fixed fallback."""
    return df.withColumn("updated_at", parse_cursor(F.col(source_col)))


_COPIES_PER_ROW = 65_536  # copies regenerated from one intermediate row


def add_row_id(df: DataFrame, columns: list[str]) -> DataFrame:
    """Surrogate id for a source that has none: a content id.

    Each distinct row with ``n`` copies gets the SHA-256 digests of (row,
    0 .. n-1), written as JSON with explicit NULLs, so a NULL never reads as its
    neighbour and exact repeats stay distinct; re-landing the same input
    yields the same ids.  A changed row gets another id: use it for full
    replaces, not as the key of an incremental merge (``upsert`` refuses).

    Copies are counted with a partial aggregate, so a group of copies that holds a
    third of the table is one row per task; its rows are regenerated in pieces
    spread over tasks.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    size = F.lit(_COPIES_PER_ROW)
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {_COPIES_PER_ROW}"))))
    spread = pieces.repartition(F.xxhash64(*[F.col(c) for c in columns], F.col("_piece")))
    rows = spread.withColumn("_occ", F.explode(F.sequence(F.col("_piece") * size,
                                                          F.least(F.col("_n"), (F.col("_piece") + 1) * size) - 1)))
    content = F.to_json(F.struct(*[F.col(c) for c in columns], F.col("_occ")), {"ignoreNullFields": "false"})
    return rows.withColumn(RAW_KEY, F.sha2(content, 256)).drop("_n", "_piece", "_occ")


def land(df: DataFrame, table: str) -> DataFrame:
    """Give a raw frame its metadata columns: a row id if missing, and the
    ``updated_at`` cursor if missing."""
    cols = RAW_COLUMNS[table]
    if RAW_KEY not in df.columns:
        df = add_row_id(df, cols)
    if "updated_at" not in df.columns:
        df = add_updated_at(df, CURSOR_SOURCE[table])
    return df.select(RAW_KEY, *cols, F.col("updated_at").cast("timestamp").alias("updated_at"))


@dataclass
class SourceRegistry:
    """Named sources: ``registry.table('billing', 'customers')`` indirection,
    so jobs never hard-code where raw data lives."""

    readers: dict[tuple[str, str], Callable[[], DataFrame]] = field(default_factory=dict)

    def register(self, source: str, table: str, reader: Callable[[], DataFrame]) -> None:
        self.readers[(source, table)] = reader

    def table(self, source: str, table: str) -> DataFrame:
        try:
            return self.readers[(source, table)]()
        except KeyError:
            raise KeyError(f"unknown source table {source}.{table}") from None

    @classmethod
    def from_paths(cls, spark: SparkSession, source: str, paths: dict[str, str],
                   fmt: str = "parquet") -> "SourceRegistry":
        reg = cls()
        for table, path in paths.items():
            if fmt == "csv":
                reg.register(source, table, lambda p=path, t=table: land(read_untyped_csv(spark, p, t), t))
            else:
                reg.register(source, table, lambda p=path: spark.read.parquet(p))
        return reg
