"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str] | str, order: list[Column | str]) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (``row_number() = 1``).

    Catalyst plans a partial ``WindowGroupLimit`` before the shuffle and a
    final one after it, so a hot key is cut to one row per map task before it
    moves.  Make ``order`` total (end with a unique column) for determinism.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .drop("_rn"))


def keep_latest(df: DataFrame, keys: list[str] | str, cursor: str,
                tiebreak: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest ``cursor`` (ties broken by ``tiebreak``
    descending)."""
    order = [F.col(cursor).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in (tiebreak or [])]
    return keep_first(df, keys, order)
