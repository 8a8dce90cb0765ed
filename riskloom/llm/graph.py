"""Connected components of an edge table by label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written, written_at

#: Shares into which the nodes that look one label up are dealt.
SHARES = 8


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for the nodes of
    ``edges`` (``a``, ``b``, long).

    Each round every node takes the smallest label among its neighbours', its
    root takes it too, and labels jump to their label's label, so the rounds
    grow with the logarithm of the longest path.  Joins on a node that many
    edges share are plain equi-joins, which adaptive execution splits; sums by
    node combine before they are shuffled.  Each round is a written table.
    """
    spark = edges.sparkSession
    both, both_path = written_at(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels, path = written_at(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked, hooked_path = written_at(labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("low")), "hooked")
        offers = hooked.select("node", "low").union(hooked.select(F.col("label").alias("node"), "low"))
        low, low_path = written_at(offers.groupBy("node").agg(F.min("low").alias("low")), "low")
        # All nodes of a component look the same label up: its rows are dealt into shares.
        looked_up = low.select(F.col("node").alias("low"), F.col("low").alias("next"),
                               F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"))
        share = F.pmod(F.xxhash64("node"), F.lit(SHARES)).cast("int")
        jumped = (hooked.select("node", "label").join(low, "node").withColumn("share", share)
                  .join(looked_up, ["low", "share"])
                  .select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")))
        after, after_path = written_at(jumped, "labels")
        for done in (path, hooked_path, low_path):
            discard(spark, done)
        labels, path = after.select("node", "label"), after_path
        if after.where("moved").isEmpty():
            discard(spark, both_path)
            return labels.select("node", F.col("label").alias("component"))
