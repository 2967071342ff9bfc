"""Database sources (the reference syncs from a relational database).

Reads are split into ``num_partitions`` range queries on a numeric column
(the surrogate row id), so a large table is read by many executors at once;
an incremental read pushes the watermark into the query itself.  Needs the
database's JDBC driver on the classpath — none ships here, so this path is
not exercised by the tests (Parquet/CSV are).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.raw import SourceRegistry, land


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str = "_row_id", lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int = 64,
              where: str | None = None) -> DataFrame:
    """Partitioned JDBC read.  Bounds default to min/max of the partition
    column (one small query); ``where`` (e.g. a watermark predicate) is
    pushed into the database query."""
    source = f"(SELECT * FROM {table} WHERE {where}) AS src" if where else table
    if lower_bound is None or upper_bound is None:
        bounds = (spark.read.jdbc(url, f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
                                       f"FROM {source}) AS b", properties=properties).first())
        lower_bound = int(bounds["lo"] or 0)
        upper_bound = int(bounds["hi"] or 0) + 1
    return spark.read.jdbc(url, source, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties)


def register_jdbc(registry: SourceRegistry, spark: SparkSession, source: str, url: str,
                  tables: list[str], properties: dict[str, str], **kw) -> SourceRegistry:
    """Register raw billing tables read from a database under ``source``."""
    for t in tables:
        registry.register(source, t, lambda t=t: land(read_jdbc(spark, url, t, properties, **kw), t))
    return registry
