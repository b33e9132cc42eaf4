"""Connected components of a distributed edge table by hooking and contraction.

Every node that has a smaller neighbour hooks onto the smallest one; the resulting trees are
flattened by pointer jumping; the edges are rewritten to the roots, and what is left between
different roots is the (much smaller) graph of the next round.  Each table is written to the
shared folder, so that no round recomputes another.  A hub meets its edges in joins whose
other side has one row a node, which AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.materialize import materialize_observed


def _through(edges: DataFrame, col: str, to_root: DataFrame) -> DataFrame:
    """Replace ``col`` by its root where it has one."""
    m = to_root.select(F.col("node").alias("m_node"), F.col("root").alias("m_root"))
    return (edges.join(m, edges[col] == m["m_node"], "left")
            .withColumn(col, F.coalesce("m_root", col)).drop("m_node", "m_root"))


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("u") != F.col("v"))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has the columns u and v.  Returns (node, root): the smallest node of the
    component, for every node that isn't its own root."""
    left, seen = materialize_observed(_ordered(edges))
    found = None
    while True:
        # each node's smallest smaller neighbour
        hooks = left.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root"))
        hooks, n = materialize_observed(hooks)
        changed = n["n"]
        while changed:
            jumped = _through(hooks.withColumn("was", F.col("root")), "root", hooks)
            hooks, n = materialize_observed(
                jumped.select("node", "root", "was"),
                F.sum((F.col("root") != F.col("was")).cast("long")).alias("changed"))
            hooks, changed = hooks.select("node", "root"), n["changed"] or 0
        found = hooks if found is None else _through(found, "root", hooks).unionByName(hooks)
        if not seen["n"]:
            return found
        left, seen = materialize_observed(_ordered(_through(_through(left, "u", hooks), "v", hooks)))
        if not seen["n"]:
            return found
