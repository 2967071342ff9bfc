"""Positions of a whole table in a total order, without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import stored


def positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in ``order``, which must be total.

    The table is dealt by ranges of the order and written once, so that the ranges stay
    what they are when a task runs again; a row's place is its place in its range plus
    the rows of the ranges before.  The window over all ranges sees one row a range."""
    for own in (name, "__range", "__before"):
        if own in df.columns:
            raise ValueError(f"the table has a column {own} of its own")
    dealt = stored(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), f"ranges-{name}")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("n")) \
        .select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.withColumn(name, place).join(sizes, "__range") \
        .select(*df.columns, (F.col(name) + F.col("__before")).alias(name))
