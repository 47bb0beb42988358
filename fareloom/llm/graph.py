"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: bigint) to (id, component): the smallest id reachable, for every id that has a link.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so that
    labels travel twice as far each time. No node's neighbours are gathered: rounds are aggregates and joins
    with one unique side, whose hot keys adaptive execution splits. Every round is written to the shared
    folder. An empty table gives an empty table.
    """
    edges = links.where("a <> b")
    edges = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(
        edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        step = labels.join(near, "id").select(
            "id", F.least("component", "m").alias("component"), F.col("component").alias("old")
        )
        step = materialize(step, "labels")
        far = step.select(F.col("id").alias("component"), F.col("component").alias("root"))
        labels = materialize(
            step.join(far, "component", "left").select("id", F.coalesce("root", "component").alias("component"), "old"),
            "labels",
        )
        if labels.where("component < old").isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")
