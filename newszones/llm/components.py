"""Connected components of a link table, by repeated joins; every round is written to the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newszones.sources.storage import work_path, write_and_read


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over ``links`` (``x, y`` longs), for nodes that have links.

    Each round hooks every node to its smallest neighbour and every neighbour to it (first larger ones, then smaller), so
    chains shorten by half a round. Minima are aggregated before the shuffle: a node with very many links is no hot spot.
    """
    spark = links.sparkSession
    edges = write_and_read(
        links.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).filter("lo < hi").distinct(),
        work_path(spark, "edges"))
    before = None
    while True:
        edges = _star(_star(edges, larger=True), larger=False)
        edges = write_and_read(edges, work_path(spark, "edges"))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi") % (1 << 30)), F.sum(F.xxhash64("hi", "lo") % (1 << 30))).first()
        if now == before:
            break
        before = now
    roots = edges.select("lo").distinct()
    return (edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
            .unionByName(roots.select(F.col("lo").alias("node"), F.col("lo").alias("component"))))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Larger: each neighbour above a node gets the node's smallest neighbour (or itself). Else: each one below."""
    if larger:
        both = edges.select(F.col("lo").alias("node"), F.col("hi").alias("near")).unionByName(
            edges.select(F.col("hi").alias("node"), F.col("lo").alias("near")))
    else:
        both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near"))
    least = both.groupBy("node").agg(F.min("near").alias("m")).withColumn("m", F.least("m", "node"))
    joined = both.join(least, "node")
    if larger:
        out = joined.filter("near > node").select(F.col("m").alias("lo"), F.col("near").alias("hi"))
    else:
        out = (joined.select(F.col("m").alias("lo"), F.col("near").alias("hi"))
               .unionByName(least.select(F.col("m").alias("lo"), F.col("node").alias("hi"))))
    return out.filter("lo < hi").distinct()
