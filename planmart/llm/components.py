"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """node, component (its smallest node), members (nodes of the component) for every node of an edge that joins two nodes.

    In each round every node steps to the least of itself and its neighbours,
    in an order hashed anew, and once more from there; edges are redrawn
    between the places reached, and those that became loops or doubles go. So
    the edges shrink from round to round (a star is gone after one), and the
    work of all rounds is a small multiple of the first. Tables are written
    after each step: joins start from them, and adaptive execution splits hot
    keys. Only whether an edge is left reaches the driver.

    Defined cases: edges from a node to itself or with a null end join nothing
    and are left out; repeated edges count once; no edges give no rows.
    """
    drawn = lambda df: df.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    live = materialize(drawn(edges.select(F.col(left).alias("u"), F.col(right).alias("v"))), "edges")
    labels, turn = live.select(F.col("u").alias("node"), F.col("u").alias("label")).limit(0), 0
    while not live.isEmpty():
        ranked = lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))
        ends = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = materialize(ends.groupBy("u").agg(F.min(ranked("v")).alias("m"))
                           .select(F.col("u").alias("node"), F.least(ranked("u"), "m")["n"].alias("to")), "steps")
        onward = step.select(F.col("node").alias("at"), F.col("to").alias("then"))
        moved = materialize(step.join(onward, step["to"] == onward["at"]).select("node", F.col("then").alias("to")), "steps")
        if turn == 0:
            labels = moved.withColumnRenamed("to", "label")
        else:
            move = moved.select(F.col("node").alias("at"), "to")
            labels = materialize(labels.join(move, labels["label"] == move["at"], "left")
                                 .select("node", F.coalesce("to", "label").alias("label")), "labels")
        a = moved.select(F.col("node").alias("u"), F.col("to").alias("a"))
        b = moved.select(F.col("node").alias("v"), F.col("to").alias("b"))
        live = materialize(drawn(live.join(a, "u").join(b, "v").select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
        turn += 1
    names = materialize(labels.groupBy("label").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("members")),
                        "components")
    return labels.join(names, "label").select("node", "component", "members")
