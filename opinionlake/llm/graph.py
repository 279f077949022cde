"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SALTS = 16


def components(spark: SparkSession, edges: DataFrame, root: str) -> DataFrame:
    """(node, label) for every node of an edge (a, b); the label is the component's smallest node.

    Alternates large and small stars until every component is one star: a number of
    rounds that grows with the logarithm of the size.  Each round is written below
    ``root``, so a lost executor costs one round at most.  No edge leaves the executors.
    """
    def stored(frame: DataFrame, turn: int) -> DataFrame:
        path = f"{root}/round-{turn}"
        frame.filter("u <> v").distinct().write.mode("overwrite").parquet(path)
        return spark.read.schema("u long, v long").parquet(path)

    def unfinished(stars: DataFrame) -> bool:
        """Whether a node has two parents, or a parent that has one."""
        ends = stars.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("child")),
                                              F.struct(F.col("v").alias("x"), F.lit(0).alias("child")))).alias("e")).select("e.*")
        seen = ends.groupBy("x").agg(F.sum("child").alias("parents"), F.min("child").alias("least"))
        return bool(seen.filter("parents > 1 OR parents = 1 AND least = 0").limit(1).count())

    def meet(stars: DataFrame, least: DataFrame) -> DataFrame:
        """Every edge with its node's smallest neighbour; the edges of a hub are dealt to many tasks."""
        salted = stars.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
        return salted.join(least.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["u", "s"]).drop("s")

    current = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), 0)
    turn = 0
    while unfinished(current):
        turn += 1
        # every node sends its larger neighbours to the smallest one
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = meet(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # every node joins its smaller neighbours to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = meet(large, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stored(small.unionByName(least.select("u", F.col("m").alias("v"))), turn)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
