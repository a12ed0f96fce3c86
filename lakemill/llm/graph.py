"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import cut, every_salt, salt_of


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of links(a, b) reaches. Nodes are those that links name.

    Every round, each node takes the smallest label among its neighbours, then the label of that label, which halves
    the length of chains. The messages are merged before each shuffle, so a hub of millions of links receives one row
    from a map task; a hub's label is dealt out by salt. Rows with a null end, and links from a node to itself, add
    nothing. The rounds end when no label changes; that takes about the logarithm of the longest chain.
    """
    both = links.where("a <> b").select("a", "b")
    both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    # Dealt once, as every round joins the edges by this key.
    edges = cut(both.select("a", "b", salt_of("b").alias("salt")).repartition("a", "salt"))
    # The first round needs no join: a node's label is the smallest of itself and its neighbours.
    labels = cut(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("changed")))
    for _ in range(rounds):
        told = labels.where("changed").select(F.col("node").alias("a"), "label", every_salt())
        offers = edges.join(told, ["a", "salt"]).groupBy("b").agg(F.min("label").alias("offer"))
        taken = labels.join(offers, labels.node == offers.b, "left").select("node", F.col("label").alias("was"), F.least("label", "offer").alias("label"))
        # What my label's node is now labelled with. Many nodes share a label: those rows are dealt by salt too.
        parents = taken.select(F.col("node").alias("up"), F.col("label").alias("over")).where("over < up").select("up", "over", every_salt())
        now = taken.select("node", "was", F.col("label").alias("up"), salt_of("node").alias("salt")).join(parents, ["up", "salt"], "left")
        labels = cut(now.select("node", F.coalesce("over", "up").alias("label"), (F.coalesce("over", "up") < F.col("was")).alias("changed")))
        if labels.where("changed").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components have not settled after {rounds} rounds")
