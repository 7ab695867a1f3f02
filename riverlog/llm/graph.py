"""Connected components with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlog.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """id, comp (the least id reachable) for every id of links(a, b).

    No links: no rows. Each round an id takes the least label of its neighbours and then its label's own label; rounds end when nothing moves.
    Labels are written to the shared folder each round, so a lost executor costs one round at most.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    if both.isEmpty():
        return both.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    label = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        step = label.join(near, "id").select("id", "comp", F.least("comp", "near").alias("to"))
        jump = step.join(label.select(F.col("id").alias("to"), F.col("comp").alias("further")), "to")
        new = stored(jump.select("id", F.col("comp").alias("was"), F.least("to", "further").alias("comp")), "labels")
        moved = not new.where("was <> comp").isEmpty()
        label = new.select("id", "comp")
        if not moved:
            return label
