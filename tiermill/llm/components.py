"""Connected components of a graph of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut, tidy


@tidy
def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of all ids in `links` (a, b).

    Rounds of large and small stars: each id sends its larger neighbours, then itself and its smaller ones, to the
    smallest that it knows, until each hangs on one that hangs on nothing. The count that begins a round shows this, so
    no further round has to. The number of links never grows, and those that become equal stay; each round is written to
    the shared folder. An id with very many links is combined before the shuffle and split by the join.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smaller, larger = F.when(F.col("b") < F.col("a"), F.col("b")), F.when(F.col("b") > F.col("a"), F.lit(True))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m"), F.max(smaller).alias("last"), F.max(larger).alias("held")).select("a", F.least("a", "m").alias("m"), "last", "held"))
        if least.filter("last is not null and (m <> last or held)").isEmpty():
            return least.select(F.col("a").alias("id"), F.col("m").alias("component"))
        large = cut(edges.join(least.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b")))
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        # each id's link to its smallest takes the place of the link that this one was
        others = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(others.union(least.select("a", F.col("m").alias("b"))))
