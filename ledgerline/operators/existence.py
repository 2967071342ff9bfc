"""Existence flags and referential (orphan) checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# NULL-key rows are spread over this many salt values (see existence_flag).
NULL_KEY_SPREAD = 1024


def existence_flag(df: DataFrame, key: str, ref: DataFrame, ref_key: str, name: str,
                   spread_by: str | None = None) -> DataFrame:
    """Add boolean ``name`` = "``df.key`` occurs in ``ref.ref_key``" (SQL
    ``EXISTS``), never NULL; a NULL key is false.

    ``ref`` keys are de-duplicated first (a partial aggregate, so a hot key is
    collapsed map-side) and left-joined; a plain join would multiply rows on
    duplicate reference keys.  The join also keys on a salt that is 0 for
    every real key and 1..NULL_KEY_SPREAD (a hash of ``spread_by``, by default the
    first other column, so that all the rest can still be pruned) for a NULL key:
    NULL keys can never match, but without the salt a table where a third of
    the rows lack the key would hash all of them into one partition.  A hot
    non-NULL key is split at runtime by AQE's skew-join handling.
    """
    hits = (ref.select(F.col(ref_key).alias("_ex_key")).where(F.col("_ex_key").isNotNull())
            .distinct().withColumn("_ex_salt", F.lit(0)).withColumn("_ex_hit", F.lit(True)))
    spread_by = spread_by or next((c for c in df.columns if c != key), key)
    salt = F.when(F.col(key).isNull(),
                  F.lit(1) + F.pmod(F.xxhash64(spread_by), F.lit(NULL_KEY_SPREAD))
                  ).otherwise(F.lit(0)).cast("int")
    probe = df.withColumn("_ex_probe_salt", salt)
    cond = (probe[key] == hits["_ex_key"]) & (probe["_ex_probe_salt"] == hits["_ex_salt"])
    return (probe.join(hits, cond, "left")
            .withColumn(name, F.coalesce(F.col("_ex_hit"), F.lit(False)))
            .drop("_ex_key", "_ex_salt", "_ex_hit", "_ex_probe_salt"))


def orphans(df: DataFrame, key: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Rows of ``df`` whose non-NULL ``key`` is absent from ``ref`` (the
    ``relationships`` test): a left anti join on the distinct reference keys."""
    parents = ref.select(F.col(ref_key).alias("_par_key")).where(F.col("_par_key").isNotNull()).distinct()
    return (df.where(F.col(key).isNotNull())
            .join(parents, F.col(key) == parents["_par_key"], "left_anti"))
