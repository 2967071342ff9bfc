"""Connected components of a link table, as alternating star contractions.

Each round moves every node's larger neighbours to its smallest neighbour
(large star) and then its smaller neighbours to the smallest of them (small
star); the links shrink to one star per component in O(log^2 n) rounds.  Every
round is a partial minimum and a join, written to the shared scratch folder,
so nothing is collected and a lost executor costs at most the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged


def _minima(links: DataFrame, both: bool) -> DataFrame:
    """(u, m): the smallest node among u and its (smaller, unless ``both``) neighbours."""
    out = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    if both:
        out = out.unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    return out.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


def _links(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("a") != F.col("b")) \
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (src, dst: long); root is the
    smallest node of its component."""
    links = staged(_links(links.select(F.col("src").alias("a"), F.col("dst").alias("b"))), "links")
    while True:
        low = staged(_minima(links, both=True), "large-star-min")
        # neighbours larger than u move to m(u)
        large = links.join(low, F.col("lo") == F.col("u")).select(F.col("hi").alias("a"), F.col("m").alias("b"))
        large = staged(_links(large), "large-star")
        small_low = staged(_minima(large, both=False), "small-star-min")
        # u's smaller neighbours, and u itself, move to the smallest of them
        moved = large.join(small_low, F.col("hi") == F.col("u"))
        pairs = moved.select(F.col("lo").alias("a"), F.col("m").alias("b")) \
            .unionByName(small_low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        after = staged(_links(pairs), "small-star")
        # settled when no node is both below one link and above another
        links = after
        if links.select("hi").join(links.select(F.col("lo").alias("hi")), "hi", "left_semi").isEmpty() \
                and links.groupBy("hi").count().where("count > 1").isEmpty():
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")) \
                .unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
