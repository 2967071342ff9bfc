"""Profiling and freshness: one aggregate pass per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.existence import orphans

# Metrics computed for every text column of a raw table (name → failing-row predicate).
TEXT_METRICS = ("null", "blank", "untrimmed", "not_lower", "numeric", "negative", "date")


def _metric(c: F.Column, metric: str) -> F.Column:
    if metric == "null":
        return c.isNull()
    if metric == "blank":
        return c == F.lit("")
    if metric == "untrimmed":
        return c != F.trim(c)
    if metric == "not_lower":
        return c != F.lower(c)
    if metric == "numeric":
        return c.try_cast("decimal(38,6)").isNotNull()
    if metric == "negative":
        return c.try_cast("decimal(38,6)") < 0
    if metric == "date":
        return c.try_cast("date").isNotNull()
    raise ValueError(metric)


def profile_table(df: DataFrame, table: str, columns: list[str] | None = None,
                  metrics=TEXT_METRICS) -> DataFrame:
    """Long profile (table_name, column_name, metric, value) of text columns:
    row count plus, per column, how many values are NULL, blank, untrimmed,
    not lower-case, numeric, negative, or parse as a date.  A single
    aggregate over the table — no distinct counts, so nothing expands rows."""
    columns = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    names = []
    for c in columns:
        for m in metrics:
            alias = f"{c}__{m}"
            aggs.append(F.count_if(F.coalesce(_metric(F.col(c), m), F.lit(False))).alias(alias))
            names.append((c, m, alias))
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(None).cast("string").alias("column_name"), F.lit("rows").alias("metric"),
                        F.col("__rows").cast("long").alias("value"))]
    entries += [F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"),
                         F.col(a).cast("long").alias("value")) for c, m, a in names]
    return wide.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))


def profile_sets(df: DataFrame, table: str, key: str, columns: list[str], domains: dict[str, tuple],
                 parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """What a row alone does not show, in the same long form: keys on several rows
    (``duplicate_key``), surplus exact copies over ``columns`` (``duplicate_row``), values
    outside a column's domain (``out_of_set``), rows whose parent is missing
    (``orphan``; ``parents``: column → (table, its key)).  NULLs are none of these,
    but for copies.  Every part is a partial aggregate first."""
    found = [("duplicate_key", key, df.where(F.col(key).isNotNull()).groupBy(key).count()
              .agg(F.count_if(F.col("count") > 1).alias("value"))),
             ("duplicate_row", None, df.groupBy(*columns).count()
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("value")))]
    found += [("out_of_set", c, df.agg(F.count_if(~F.col(c).isin(list(values))).alias("value"))) for c, values in domains.items()]
    found += [("orphan", c, orphans(df.select(c), c, parent, parent_key).agg(F.count(F.lit(1)).alias("value")))
              for c, (parent, parent_key) in parents.items()]
    parts = [counted.select(F.lit(table).alias("table_name"), F.lit(c).cast("string").alias("column_name"),
                            F.lit(metric).alias("metric"), F.col("value").cast("long").alias("value"))
             for metric, c, counted in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_freshness(df: DataFrame, resource: str, loaded_at: str, now,
                     warn_after_hours: int = 24, error_after_hours: int = 48) -> DataFrame:
    """max(loaded_at) against ``now``: age in whole hours and a status
    (pass / warn / error, or ``future`` when the newest row is dated after
    ``now`` — the poisoned-cursor case)."""
    now_ts = F.lit(str(now)).cast("timestamp")
    newest = F.max(F.col(loaded_at).cast("timestamp"))
    out = df.agg(newest.alias("max_loaded_at"))
    age = F.floor((F.unix_timestamp(now_ts) - F.unix_timestamp("max_loaded_at")) / 3600).cast("long")
    return out.select(
        F.lit(resource).alias("resource"), "max_loaded_at", age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(age < 0, "future")
         .when(age >= error_after_hours, "error")
         .when(age >= warn_after_hours, "warn").otherwise("pass").alias("status"))
