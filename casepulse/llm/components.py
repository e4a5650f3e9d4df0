"""Connected components of links, entirely in joins and aggregates.

Links become few after some rounds, or are from the start. A table that cannot have more than
``ROWS`` rows for each shuffle partition is dealt to fewer tasks, and one of up to ``SENT`` rows is
sent to all of them instead of joined by a shuffle: else each of many rounds would start every
partition several times for next to nothing, all of which the driver keeps a record of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casepulse.llm.store import cut

#: Rows that are worth a task of their own, and rows of two numbers up to which they are sent to all tasks.
ROWS, SENT = 4096, 100_000


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for each end of a link ``a``, ``b``.

    Each round hooks every node to its least neighbour below it, follows the hooks to their
    roots and contracts the links to the roots. The contracted graph has fewer nodes by a
    constant factor, so a logarithmic number of rounds is enough, also for long chains. Hooks
    are minima, which tasks combine before the shuffle: a node of many links is no hot key.
    """
    most = links.count()
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = cut(_dealt(edges, most))
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("label"))
    labels = cut(_dealt(labels, 2 * most))
    while n := edges.count():
        roots = _roots(edges, n)
        moved = _sent(roots.select(F.col("node").alias("label"), F.col("root")), 2 * n)
        labels = labels.join(moved, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
        labels = cut(_dealt(labels, 2 * most))
        left = _sent(roots.select(F.col("node").alias("a"), F.col("root").alias("x")), 2 * n)
        right = _sent(roots.select(F.col("node").alias("b"), F.col("root").alias("y")), 2 * n)
        contracted = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = cut(_dealt(contracted.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), n))
    return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` as :func:`components` would give them with ``links`` besides; only what these join is gone through again."""
    n, nodes = links.count(), labels.count()
    if not n:
        return labels
    left = _sent(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), nodes)
    right = _sent(labels.select(F.col("node").alias("b"), F.col("label").alias("y")), nodes)
    ends = links.select("a", "b").join(left, "a", "left").join(right, "b", "left")
    joined = components(cut(_dealt(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")), n)))
    moved = _sent(joined.select(F.col("node").alias("label"), F.col("label").alias("root")), 2 * n)
    before = labels.join(moved, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    new = joined.join(_sent(labels.select("node"), nodes), "node", "left_anti")
    return cut(_dealt(before.union(new), nodes + 2 * n))


def _dealt(frame: DataFrame, most: int) -> DataFrame:
    """The frame of at most so many rows, in a task for each ``ROWS`` of them where that is fewer than it has."""
    return frame.coalesce(max(1, -(-most // ROWS)))


def _sent(frame: DataFrame, most: int) -> DataFrame:
    """The frame of at most so many rows, marked to be sent to all tasks where they are few."""
    return F.broadcast(frame) if most <= SENT else frame


def _roots(edges: DataFrame, n: int) -> DataFrame:
    """``node`` and ``root`` after following each node's hook to its least neighbour, if that is below it; ``n`` edges."""
    hooks = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    own = edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    hooks = cut(_dealt(hooks.union(own).groupBy("node").agg(F.min("root").alias("root")), 2 * n))
    while True:
        next_ = _sent(hooks.select(F.col("node").alias("root"), F.col("root").alias("above")), 2 * n)
        moved = hooks.join(next_, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved"))
        moved = cut(_dealt(moved, 2 * n))
        changed = not moved.where("moved").isEmpty()
        hooks = moved.select("node", "root")
        if not changed:
            return hooks
