"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.sources.workspace import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges`, two columns of one ordered type.

    The component is its least node. Edges may repeat, point either way or be loops; rows
    with a null end are no edges. No edges give no rows. Each round replaces the edges by
    at most as many (plus one a node) that lead closer to the least node, and writes them
    to the shared folder, so that a lost executor costs a re-read. A hub is never gathered:
    its minimum is a partial aggregate, and its edges pass through a join that Spark may
    split. The rounds grow with the logarithm of the longest path.
    """
    first, second = edges.columns
    a, b = F.col(first), F.col(second)
    pairs = edges.where(a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    nodes = stored(pairs.distinct(), "components")
    now, before = nodes.where("u != v"), None
    while True:
        now = stored(_small_star(_large_star(now)), "components")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    alone = nodes.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return alone.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour, or the node."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.where("v > u").join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()
