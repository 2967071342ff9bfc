"""Rows an incremental load missed: reconciliation by bucket digests.

A cursor never sees a row that arrives late with a cursor below the watermark, nor
a change that leaves the cursor alone.  Both tables are cut into buckets by key;
a bucket's digest is its row count and order-free sums of 128 bits of row
hash.  Equal digests settle a bucket; only the buckets that differ are compared
row by row, and there by counting versions, not by a full join of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16  # also the bound on what is broadcast: one int a bucket


def _row_hash(df: DataFrame, columns: list[str], lane: int) -> Column:
    # Hash functions skip NULLs, so each column is hashed with its NULL mark.
    return F.xxhash64(F.lit(lane), *[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _tagged(df: DataFrame, keys: list[str], columns: list[str], buckets: int, side: int) -> DataFrame:
    """(keys, _bucket, _h0, _h1, _side).  Rows with a NULL in their key are spread over the buckets by content."""
    hashed = df.select(*keys, _row_hash(df, columns, 0).alias("_h0"), _row_hash(df, columns, 1).alias("_h1"))
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.when(keyless, F.col("_h0"))), F.lit(buckets)).cast("int")
    return hashed.select(*keys, bucket.alias("_bucket"), "_h0", "_h1", F.lit(side).alias("_side"))


def _digest(rows: DataFrame) -> DataFrame:
    """(_bucket, rows and four sums): hashes are summed in halves of 32 bits, which
    2^31 rows a bucket cannot overflow (and overflow is an error, not a wrong sum)."""
    low = [(F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)) * F.col("_side")) for h in ("_h0", "_h1")]
    high = [F.shiftright(h, 32) * F.col("_side") for h in ("_h0", "_h1")]
    return rows.groupBy("_bucket").agg(F.sum("_side").alias("n"),
                                       *[F.sum(x).alias(f"d{i}") for i, x in enumerate(low + high)])


def differing_rows(source: DataFrame, target: DataFrame, keys: list[str] | str, columns: list[str] | None = None,
                   buckets: int = BUCKETS) -> DataFrame:
    """(keys, kind) of each key whose rows differ: ``missing`` in the target,
    ``extra`` there, or ``changed``.  ``columns`` (default: the source's) are compared in
    the source's types; keys may repeat or be NULL, and then the
    collections of rows are compared.  Columns of map type have no hash and cannot be compared.

    Shuffled are at most ``buckets`` digests a task, and the rows of the buckets that differ.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = columns or source.columns
    aligned = target.select(*[F.col(c).cast(source.schema[c].dataType).alias(c) for c in dict.fromkeys([*keys, *columns])])
    both = _tagged(source, keys, columns, buckets, 1).unionByName(_tagged(aligned, keys, columns, buckets, -1))
    digests = _digest(both)
    odd = digests.where(" OR ".join(f"{c} <> 0" for c in digests.columns if c != "_bucket")).select("_bucket")
    versions = (both.join(F.broadcast(odd), "_bucket", "left_semi")  # at most ``buckets`` ints
                .groupBy(*keys, "_h0", "_h1").agg(F.sum("_side").alias("_n")).where(F.col("_n") != 0))
    return versions.groupBy(*keys).agg(
        F.when(F.min("_n") > 0, "missing").when(F.max("_n") < 0, "extra").otherwise("changed").alias("kind"))


def missed_rows(source: DataFrame, target: DataFrame, keys: list[str] | str, columns: list[str] | None = None,
                buckets: int = BUCKETS, kinds: DataFrame | None = None) -> DataFrame:
    """The source's rows that an upsert has to bring again (missing or changed), with all columns.
    ``kinds`` is the result of ``differing_rows`` where it is at hand (stored)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    kinds = differing_rows(source, target, keys, columns, buckets) if kinds is None else kinds
    again = kinds.where(F.col("kind") != "extra") \
        .select(*[F.col(k).alias(f"_again_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_again_{k}"))
    return source.join(again, same, "left_semi")
