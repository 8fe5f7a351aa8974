"""Connected components of a table of links, by alternating stars.

The large star links every greater neighbour of a node to the least of its neighbourhood, the small star
every lesser one. Both only regroup links, so the table never grows beyond the links given, and the rounds
grow with the logarithm of the longest chain. Minima are aggregated before they are shuffled and joined
back, so a node with a third of all links is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import drop_folder, scratch


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): for every node with a link, the least node that it reaches.

    Null ends, loops and repeated links do no harm. Each round is written to the shared folder, as the next
    one reads it several times.
    """
    spark = links.sparkSession
    now = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
    before, path, mark = None, None, None
    while True:
        after = scratch(spark, "links")
        step = now if path is None else _small(_large(now))
        step.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().write.parquet(after)
        now = spark.read.schema("u bigint, v bigint").parquet(after)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None:
            drop_folder(spark, before)
        before, path = path, after
        if tuple(state) == mark:
            break
        mark = tuple(state)
    if before is not None:
        drop_folder(spark, before)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
