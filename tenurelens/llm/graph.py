"""Connected components by alternating stars, with no vertex or link on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.llm.scratch import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Large and small stars in turn: each round hangs neighbours onto the smallest one seen,
    which leaves one star per component after about log(nodes) rounds. A hub of many links
    is summed on the map side, and the joins on it are equi-joins that adaptive execution
    splits. Rounds are checkpointed. Self links and null ends are ignored.
    """
    edges = cut(
        links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("lo") < F.col("hi")))
        .distinct()
    )
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = cut(_small_star(_large_star(edges)))
    ends = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return ends.unionAll(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(
        edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    )
    # a table of its own, so that adaptive execution can split the join on a hub of many links
    least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    hung = edges.join(least, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return (
        hung.unionAll(least.select(F.col("m").alias("lo"), "hi"))
        .where(F.col("lo") < F.col("hi"))
        .distinct()
    )
