"""Connected components of a link table, as a few joins per round.

Every node starts with its own id as label.  A round gives each node the
smallest label among its own and its neighbours', then follows the label's
label (pointer jumping), so long chains shrink quickly.  Rounds are written
to the shared folder; labels and links stay distributed.  Finished when no
label changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.storage import materialize


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links (any direction, repeats allowed) -> ``node, component``
    (the smallest node id reachable) for every node with a link."""
    both = (links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b"))
    label = materialize(both.groupBy(F.col("a").alias("node"))
                            .agg(F.least(F.min("b"), F.min("a")).alias("component")), "cc-labels")
    # a link to the neighbourhood's smallest node keeps components connected
    # and turns hubs into stars; only links between different labels remain
    while True:
        la = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        lb = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        cross = both.join(la, "a").join(lb, "b").where("ca <> cb")
        # smallest label seen across any link, per label
        better = (cross.groupBy(F.greatest("ca", "cb").alias("component")).agg(F.min(F.least("ca", "cb")).alias("to")))
        better = materialize(better, "cc-better")
        if better.isEmpty():
            return label
        # follow chains of labels (from larger to smaller) to their end
        jump = better
        while True:
            nxt = jump.select(F.col("component").alias("to"), F.col("to").alias("to2"))
            jump2 = materialize(jump.join(nxt, "to", "left")
                                    .select("component", F.coalesce("to2", "to").alias("to"),
                                            F.col("to2").isNotNull().alias("moved")), "cc-jump")
            jump = jump2.select("component", "to")
            if jump2.where("moved").isEmpty():
                break
        label = materialize(label.join(jump, "component", "left")
                                 .select("node", F.coalesce("to", "component").alias("component")), "cc-labels")
