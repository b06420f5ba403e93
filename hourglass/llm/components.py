"""Connected components of a link table, by hooking and contraction.

In a round every label with links hooks to its least neighbour, whether that is
smaller or not.  The only cycles are pairs of labels that are each other's
least neighbour (along a longer one each label would have to be at most the one
two steps before it); the smaller of such a pair becomes a root.  Pointers then
jump until all stand on roots, and the links are rewritten to roots; links
inside a root vanish.  Every root has taken in at least one other label, so a
round at least halves the labels that have links, whatever the shape of the
graph; a chain of n labels needs at most log3(n) + 1 jumps in a round, as each
jump goes three times as far as the one before it.  Nothing is collected: all tables live in the shared
folder, and a table is removed once the next one stands in its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.support import discard, materialize


def _to_roots(hook: DataFrame) -> tuple[DataFrame, int]:
    """``node, to`` with every ``to`` a root (one that points to itself), and the jumps made.

    A jump goes three pointers on; where the last of them stays, a root is reached.
    """
    jumps = 0
    while True:
        first = hook.select(F.col("node").alias("to"), F.col("to").alias("_first"))
        second = hook.select(F.col("node").alias("_first"), F.col("to").alias("_second"))
        ahead = hook.select("node", "to").join(first, "to").join(second, "_first")
        stepped = materialize(ahead.select("node", F.col("_second").alias("to"), (F.col("_second") != F.col("_first")).alias("moved")), "jump")
        discard(hook)
        hook, jumps = stepped, jumps + 1
        if hook.filter("moved").isEmpty():
            return hook, jumps


def components_and_steps(links: DataFrame) -> tuple[DataFrame, int]:
    """:func:`components`, and the number of rounds and jumps that it took."""
    edges = materialize(links.select("a", "b").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    label, steps = None, 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        # A pair that hook to each other: the smaller one is the root.
        back = least.select(F.col("node").alias("to"), F.col("to").alias("_back"))
        paired = (F.col("_back") == F.col("node")) & (F.col("node") < F.col("to"))
        hook = materialize(least.join(back, "to").select("node", F.when(paired, F.col("node")).otherwise(F.col("to")).alias("to")), "hook")
        hook, jumps = _to_roots(hook)
        steps += 1 + jumps
        before, label = label, hook.select("node", F.col("to").alias("comp"))
        if before is not None:
            step = hook.select(F.col("node").alias("comp"), "to")
            label = materialize(
                before.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "label"
            )
            discard(before)
        ends = [hook.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")) for c in ("a", "b")]
        moved = reduce(lambda e, end: e.join(end, end.columns[0]), ends, edges)
        left = materialize(
            moved.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links"
        )
        discard(edges, *([] if before is None else [hook]))
        edges = left
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")), steps
    least = label.groupBy("comp").agg(F.min("node").alias("_least"))
    named = materialize(label.join(least, "comp").select("node", F.col("_least").alias("comp")), "components")
    discard(edges, label)
    return named, steps


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``links(a, b)``: the least node that it reaches.

    Links with a null end and links of a node to itself are no links; repeated
    links count once; without links there are no rows.  Other columns are not read.
    """
    return components_and_steps(links)[0]
