"""Connected components by alternating large and small stars, as joins and grouped minima.

Per round every node is grouped twice with a map-side minimum, and joined back; a centre with
many links is a hot key that Spark's skew join splits. Each round is written to the shared
folder, which cuts the lineage. The rounds end when the links stay the same (one row is read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a, b), a > b. Large: of each node's neighbours the larger ones move to the least of
    its neighbourhood; small: its smaller neighbours and itself do."""
    if large:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) of longs, in any order, repeats and self-links allowed, no nulls. Returns
    (node, root) for every node that isn't the least of its component, root being the least."""
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a > b").distinct(), "links")
    before = _digest(links)
    while True:
        links = written(_star(_star(links, large=True), large=False), "links")
        now = _digest(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
