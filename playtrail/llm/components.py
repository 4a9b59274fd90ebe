"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.stages import keep_table


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select("least", "b")
        .filter("least < b")
        .select(F.col("least").alias("a"), "b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    joined = links.join(least, "b").select("least", F.explode(F.array("a", "b")).alias("b"))
    return joined.filter("least < b").select(F.col("least").alias("a"), "b").distinct()


def _print(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """For every linked node but the smallest of its component: node, component.

    ``component`` is the smallest node that links lead to. Nodes that are their own
    component are left out, so callers fall back to the node itself. Each round is a
    written table; the number of rounds grows with the logarithm of the size.
    """
    smaller, larger = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    links = links.select(smaller.alias("a"), larger.alias("b")).filter("a < b").distinct()
    links = keep_table(links, "links")
    seen = _print(links)
    while True:
        links = keep_table(_small_star(_large_star(links)), "stars")
        now = _print(links)
        if now == seen:
            return links.select(F.col("b").alias("node"), F.col("a").alias("component"))
        seen = now
