"""Declarative data-quality checks.

A check selects *failing records*; zero failures = pass.  Failures are
counted the way SQL data tests conventionally count them: ``unique`` and
``accepted_values`` count offending *values*, the others count rows.
Severity ``warn`` reports and continues; ``error`` makes ``raise_on_error``
fail after every check has run.

Row-wise checks of one model (``not_null``, ``not_future_date``,
``flag_equals``, ``expression``) are folded into a single aggregate pass over
that model, its ``accepted_values`` checks into another; set-based checks (``unique``,
``relationships``, ``unique_combination``, ``row_count_matches``, ``rows``)
are each one aggregate.  The result is one lazy DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import as_of_literal
from ledgerline.operators.existence import orphans

# Checks evaluated inside one aggregate pass per model.
ROW_WISE = {"not_null", "not_future_date", "flag_equals", "expression"}
# Texts longer than this are compared by their SHA-256 in ``unique``.
LONG_TEXT = 64
RESULT_COLUMNS = ["check_name", "model", "kind", "column_name", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None
    predicate: str | None = None          # expression: SQL predicate selecting failing rows
    columns: tuple = ()                   # unique_combination
    rows: Callable | None = field(default=None, compare=False)  # rows: resolver -> failing rows
    name: str | None = None

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        col = self.column or "_".join(self.columns)
        return f"{self.kind}_{self.model}_{col}" if col else f"{self.kind}_{self.model}"


class CheckFailed(RuntimeError):
    pass


def _failing_predicate(check: Check, as_of) -> Column:
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "not_future_date":
        return c > as_of_literal(as_of)
    if check.kind == "flag_equals":
        return ~c.eqNullSafe(F.lit(check.values[0]))
    if check.kind == "expression":
        return F.expr(check.predicate)
    raise ValueError(check.kind)


def _row_wise_count(check: Check, as_of) -> Column:
    return F.count_if(_failing_predicate(check, as_of)).cast("long")


def _count(df: DataFrame, check: Check) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("long").alias("failures")) \
             .select(F.lit(check.check_name).alias("check_name"), "failures")


def _set_based(check: Check, resolve: Callable[[str], DataFrame]) -> DataFrame:
    df = resolve(check.model)
    if check.kind == "unique":
        value = F.col(check.column)
        if dict(df.dtypes)[check.column] == "string":
            # A long text is shuffled as its digest; no UTF-8 text starts with the byte FF.
            digest = F.concat(F.unhex(F.lit("FF")), F.unhex(F.sha2(value.cast("binary"), 256)))
            value = F.when(F.octet_length(value) > LONG_TEXT, digest).otherwise(value.cast("binary"))
        dup = (df.select(value.alias("value")).where(F.col("value").isNotNull()).groupBy("value").count()
               .where(F.col("count") > 1))
        return _count(dup, check)
    if check.kind == "unique_combination":
        dup = df.groupBy(*check.columns).count().where(F.col("count") > 1)
        return _count(dup, check)
    if check.kind == "relationships":
        return _count(orphans(df.select(check.column), check.column,
                              resolve(check.to_model), check.to_field), check)
    if check.kind == "row_count_matches":
        # Failing "row" = the two counts differ: 1 failure, else 0.
        expected = resolve(check.to_model).agg(F.count_distinct(check.to_field).alias("n"))
        actual = df.agg((-F.count(F.lit(1))).alias("n"))
        # Two one-row counts, compared after a union (no join needed).
        return (expected.unionByName(actual)
                .agg(F.when(F.sum("n") != 0, 1).otherwise(0).cast("long").alias("failures"))
                .select(F.lit(check.check_name).alias("check_name"), "failures"))
    if check.kind == "rows":
        return _count(check.rows(resolve), check)
    raise ValueError(f"unknown check kind {check.kind}")


def _foreign_values(spark: SparkSession, df: DataFrame, checks: list[Check]) -> DataFrame:
    """All ``accepted_values`` checks of a model in one pass that emits only the
    values out of their set; these are made distinct and counted per check."""
    found = F.array(*[F.when(~F.col(ch.column).isin(list(ch.values)),
                             F.struct(F.lit(ch.check_name).alias("check_name"), F.col(ch.column).cast("string").alias("value")))
                      for ch in checks])
    counts = (df.select(F.inline(F.filter(found, lambda x: x.isNotNull()))).distinct()
              .groupBy("check_name").agg(F.count(F.lit(1)).cast("long").alias("n")))
    names = spark.createDataFrame([(ch.check_name,) for ch in checks], "check_name string")
    return names.join(counts, "check_name", "left").select("check_name", F.coalesce("n", F.lit(0).cast("long")).alias("failures"))


def run_checks(spark: SparkSession, checks: list[Check], resolve: Callable[[str], DataFrame],
               as_of) -> DataFrame:
    """Evaluate ``checks`` against models from ``resolve(name)``; one row per
    check: check_name, model, kind, column_name, severity, failures, status."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    accepted: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ROW_WISE:
            by_model.setdefault(ch.model, []).append(ch)
        elif ch.kind == "accepted_values":
            accepted.setdefault(ch.model, []).append(ch)
        else:
            parts.append(_set_based(ch, resolve))
    parts += [_foreign_values(spark, resolve(model), group) for model, group in accepted.items()]
    for model, group in by_model.items():
        df = resolve(model)
        counts = df.agg(*[_row_wise_count(ch, as_of).alias(f"c{i}") for i, ch in enumerate(group)])
        pairs = F.array(*[F.struct(F.lit(ch.check_name).alias("check_name"),
                                   F.col(f"c{i}").alias("failures")) for i, ch in enumerate(group)])
        parts.append(counts.select(F.inline(pairs)))
    if not parts:
        return spark.createDataFrame(
            [], "check_name string, model string, kind string, column_name string, severity string, "
                "failures bigint, status string")
    counts_df = parts[0]
    for p in parts[1:]:
        counts_df = counts_df.unionByName(p)
    meta = spark.createDataFrame(
        [(ch.check_name, ch.model, ch.kind, ch.column or ",".join(ch.columns) or None, ch.severity)
         for ch in checks],
        "check_name string, model string, kind string, column_name string, severity string")
    return (F.broadcast(meta).join(counts_df, "check_name", "inner")
            .withColumn("status", F.when(F.col("failures") == 0, "pass")
                        .when(F.col("severity") == "warn", "warn").otherwise("error"))
            .select(*RESULT_COLUMNS))


def raise_on_error(results: DataFrame) -> list:
    """Raise ``CheckFailed`` if any error-severity check failed (after all
    checks ran); return the list of warn rows otherwise.  Collects only the
    per-check result rows (one per check), never data rows."""
    rows = results.where(F.col("status") != "pass").collect()
    errors = [r for r in rows if r["status"] == "error"]
    if errors:
        raise CheckFailed("; ".join(f"{r['check_name']}={r['failures']}" for r in errors))
    return rows
