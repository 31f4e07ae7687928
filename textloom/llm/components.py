"""Connected components by contraction: every vertex hooks onto its smallest neighbour, the
hooks are followed to their roots by pointer doubling, and the edges between roots are the next
round's graph. At least half of the vertices that still have edges go in each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import Workspace


def _roots(hooks: DataFrame, space: Workspace) -> DataFrame:
    """``hooks``: node, up (up <= node). Doubles until every ``up`` is a root."""
    while True:
        above = hooks.select(F.col("node").alias("__up"), F.col("up").alias("__upper"))
        jumped = hooks.join(above, F.col("up") == F.col("__up"), "left").select(
            "node", F.coalesce("__upper", "up").alias("up"), (F.col("__upper") < F.col("up")).alias("moved")
        )
        hooks = space.written(jumped, "roots")
        moved = hooks.where("moved").limit(1).count()
        hooks = hooks.select("node", "up")
        if not moved:
            return hooks


def components(edges: DataFrame, space: Workspace | None = None) -> DataFrame:
    """``edges``: a, b, in any order and number. A row per vertex: node, comp (the smallest
    vertex that it reaches). Vertices are what the edges name; no edges, no rows. Tables are
    written to ``space``, whose owner deletes them."""
    space = space or Workspace(edges.sparkSession, "components")
    written = space.written
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("up")).unionAll(edges.select("b", "a"))
        hooks = both.groupBy("node").agg(F.min("up").alias("up")).select("node", F.least("node", "up").alias("up"))
        roots = _roots(written(hooks, "hooks"), space)
        if labels is None:
            labels = roots.select("node", F.col("up").alias("comp"))
        else:
            step = roots.select(F.col("node").alias("comp"), "up")
            labels = written(labels.join(step, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "labels")
        a = roots.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        mapped = edges.join(a, "a").join(b, "b").where("ra <> rb")
        edges = written(
            mapped.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges"
        )
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
