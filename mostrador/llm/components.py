"""Connected components of a table of links, by alternating large and small stars.

Every round hangs the larger neighbours of each node, then its smaller ones, on the
least of them. Rows per round are at most those of the links; the number of rounds grows
with the logarithm of the longest path. Each round is written to the shared folder, so
a lost executor costs one re-read, and only one pair of totals comes to the driver.

Edge cases: links with a null end and links of a node to itself are left out, repeated links
count once, no links give no rows, and columns besides the two ends are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.session import shared_folder

MOST_ROUNDS = 60


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` (the least node reachable) of every node that has a link to another."""
    spark = links.sparkSession
    folder = shared_folder(spark, "stars")
    clean = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where(F.col("u") != F.col("v"))
    pairs = clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    for round_ in range(MOST_ROUNDS):
        if round_:
            pairs = _small_star(_large_star(pairs))
        pairs.write.mode("overwrite").parquet(f"{folder}/{round_}")
        pairs = spark.read.parquet(f"{folder}/{round_}")
        mixed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = tuple(pairs.agg(F.count("*"), mixed).first())
        if state == before or state[0] == 0:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    # At rest every node hangs on the least of its component.
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours hang on the least of itself and all its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = both.where(F.col("v") > F.col("u")).join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the least of these."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    hung = pairs.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
