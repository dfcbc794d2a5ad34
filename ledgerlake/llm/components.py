"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import drop_stored, stored

#: Links that a task of a round has at most.
LINKS_PER_TASK = 50_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node that links lead to, for every node of `links` (two columns of
    one type, in any direction; repeated links and links to itself do no harm).

    Each round a node takes the smallest label among its neighbours' and its own, then its label's
    label, so that rounds grow with the logarithm of the longest path. Minima are combined before
    rows move, so a node with very many links is one row per task; nothing meets on the driver but
    the number of changes.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    both = stored(
        pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "components-links",
    )
    # Many rounds over few links: not more tasks than they fill.
    tasks = both.count() // LINKS_PER_TASK + 1
    labels = stored(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("label"))
        .coalesce(tasks),
        "components",
    )
    both = both.coalesce(tasks)
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("label").alias("near"))
            .coalesce(tasks)
        )
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "label", F.least("label", "near").alias("best")
        )
        ends = labels.select(F.col("node").alias("end"), F.col("label").alias("beyond"))
        jumped = step.join(ends, F.col("best") == F.col("end"), "left").select(
            "node", F.least("best", "beyond").alias("new"), "label"
        )
        found = stored(jumped.coalesce(tasks), "components")
        changed = found.where("new != label").limit(1).count()
        drop_stored(labels)
        labels = found.select("node", F.col("new").alias("label"))
        if not changed:
            drop_stored(both)
            return labels
