"""Connected components of a table of links, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; ``component`` is the smallest node reachable.

    Each round, every node points to its neighbour (or itself) of lowest priority, where the priority is a hash that
    changes with the round, and links are rewritten by these pointers.  Random priorities shrink any shape, long paths
    included, by a constant share of the nodes in a round.  Links are de-duplicated after each round and kept in stored
    tables; nothing is collected.  Links with a null end and self links are ignored; an empty table gives an empty one.
    """
    live = stored(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    ends = live.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = stored(ends.select("node", F.col("node").alias("root")), "labels")
    round_no = 0
    while not live.isEmpty():
        both = live.select("a", "b").union(live.select("b", "a")).toDF("u", "v")
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_no)).alias("p"), F.col(c).alias("to"))
        step = both.groupBy("u").agg(F.min(rank("v")).alias("m")).select("u", F.least(rank("u"), F.col("m"))["to"].alias("to"))
        step = stored(step, "step")
        pa_, pb = step.toDF("a", "x"), step.toDF("b", "y")
        live = stored(
            live.join(pa_, "a").join(pb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
        label = stored(label.join(step.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        round_no += 1
    least = stored(label.groupBy("root").agg(F.min("node").alias("component")), "least")
    return label.join(least, "root").select("node", "component")
