"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.operators.stored import written_once


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node that has a link: node, component.

    Labels travel along links and then jump to the label of their label, so chains
    shrink by half a round.  Every round is written to the shared folder; only
    the number of changed labels reaches the driver.  Rows with a null end and
    self-links are ignored, repeated links do no harm, no links give no rows.
    """
    plain = links.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = written_once(plain.unionByName(plain.select(F.col("v").alias("u"), F.col("u").alias("v")))
                         .distinct())
    labels = written_once(edges.groupBy(F.col("u").alias("node"))
                          .agg(F.min("v").alias("m"))
                          .select("node", F.least("node", "m").alias("component")))
    while True:
        heard = (
            edges.join(labels, F.col("u") == F.col("node"))
            .groupBy("v").agg(F.min("component").alias("heard"))
        )
        told = written_once(
            labels.join(heard, F.col("node") == F.col("v"))
            .select("node", F.col("component").alias("old"),
                    F.least("component", "heard").alias("component")))
        parents = told.select(F.col("node").alias("parent"), F.col("component").alias("above"))
        jumped = written_once(
            told.join(parents, F.col("component") == F.col("parent"))
            .select("node", "old", F.least("component", "above").alias("component")))
        labels = jumped.select("node", "component")
        if jumped.where(F.col("old") != F.col("component")).limit(1).count() == 0:
            return labels
