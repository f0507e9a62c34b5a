"""Connected components by DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, salted_join, stored


def components(edges: DataFrame) -> DataFrame:
    """``v``, ``c`` for every end of ``edges`` (a, b): c is the smallest vertex that v reaches.

    Each round gives a vertex the smallest label around it and then the label of
    that label, so paths shorten as they are walked.  Every round is written, as
    lineage would grow otherwise, and the round before is deleted.  A hub costs no
    more than its edges: both steps are joins and minimum sums.  Many vertices may
    share a label: each label is resolved once, and the join that brings the result
    back is salted.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("c")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        step = stored(labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "m").alias("c")), "step")
        # Only labels that have a smaller label themselves; those of the largest components have none as a rule.
        to = step.select("c").distinct().join(labels.select(F.col("v").alias("c"), F.col("c").alias("further")).where("further < c"), "c")
        new = stored(salted_join(step, to, "c", "left").select("v", "old", F.least("c", F.coalesce("further", "c")).alias("c")), "labels")
        dropped(step)
        dropped(labels)
        labels = new.select("v", "c")
        if new.where("c <> old").isEmpty():
            dropped(both)
            return labels
