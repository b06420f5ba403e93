"""Merkle manifest of a dataset and octopus multiproofs of its rows.

Every row is a leaf; per tree (source) the leaves, in id order, are folded 16
at a time up to a subroot, and the subroots, in source order, up to the root.
All nodes stand in one table, ``(tree, level, pos, hash)``.

Proofs are not looked up one by one.  A block of neighbouring leaves lists the
node coordinates that its leaves' proofs need and that its own leaves cannot
give -- the minimal union, as inner nodes above known children are derived --,
fetches each of them once by a join, derives the shared inner nodes, and then
expands the proofs of its leaves locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.support import ascii_lower, materialize

FAN = 16
#: Leaves of a block; a divisor of 2**33, so that no block crosses a partition of the sorted leaves.
BLOCK = 4096
TOP = "t"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _upwards(level0: DataFrame, most: int) -> list[DataFrame]:
    """The inner levels over ``(tree, pos, n, hash)``; ``n``: leaves of the tree,
    at most ``most``.  A group is one run, ``FAN`` nodes at most."""
    out, below, level = [], level0.select("tree", "pos", "n", "hash"), 0
    while FAN**level < most:
        left = F.ceil(F.col("n") / F.lit(FAN**level))
        runs = below.where(left > 1).groupBy("tree", "n", F.expr(f"pos div {FAN}").alias("run"))
        run = F.sort_array(F.collect_list(F.struct("pos", "hash")))
        below = runs.agg(digest(F.array_join(F.transform(run, lambda e: e["hash"]), "")).alias("hash")).withColumnRenamed("run", "pos")
        level += 1
        below = materialize(below.select("tree", "pos", "n", "hash", F.lit(level).alias("level")), f"merkle-{level}")
        out.append(below)
    return out


@dataclass
class Manifest:
    """``leaves``: tree, pos, n, block, doc_id, leaf; ``nodes``: tree, level,
    pos, hash (the top tree's name is ``TOP``, its leaves are the subroots);
    ``trees``: tree, n, place (position of its subroot), trees (their number)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def build_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", tree_col: str = "source", claim: Column | None = None, block: int = BLOCK) -> Manifest:
    """Leaves and all nodes of ``docs``.

    ``claim``: what stands in place of the last field in a second leaf,
    ``claimed``, that the proofs are tested with (default: the field itself).
    ``block``: leaves of a block, a power of two.

    Rows that repeat an id are neighbours (ordered by their leaves); a null id
    comes first, and null is a tree of its own, the first one.  Null fields
    count as ``-``; an empty table has no nodes.  Other columns are not read.
    """
    columns = [F.col(f"`{c}`") for c in fields]
    tree, own = F.col(f"`{tree_col}`"), leaf_of(*columns)
    name = F.coalesce(F.concat(F.lit("s"), tree.cast("string")), F.lit("n"))
    claimed = own if claim is None else F.when(claim.eqNullSafe(columns[-1]), own).otherwise(leaf_of(*columns[:-1], claim))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), name.alias("tree"), own.alias("leaf"), claimed.alias("claimed"))
    # Sorted by ranges: a large tree spans many partitions.  The row numbers are stored, so later jobs agree on them.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "tree", "doc_id", "leaf").sortWithinPartitions("tree", "doc_id", "leaf")
    ordered = materialize(ordered.select("*", F.monotonically_increasing_id().alias("at")), "merkle-leaves")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    # One row per (partition, tree): how many leaves of the tree stand in earlier partitions.
    shares = ordered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = materialize(shares.withColumn("prior", F.coalesce(F.sum("c").over(before), F.lit(0))), "merkle-shares")
    trees = shares.groupBy("tree").agg(F.sum("c").alias("n"), F.min("first").alias("first"))
    # Subroot places: the trees lie in leaf order already, numbered through their counts per partition.
    heads = trees.withColumn("part", F.shiftright("first", 33))
    per = heads.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    # A row per partition of the sort, a number that the session fixes.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("prior"), F.sum("c").over(Window.partitionBy()).alias("trees"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    trees = heads.withColumn("within", within).join(per, "part").select("tree", "n", (F.col("prior") + F.col("within")).alias("place"), "trees")
    trees = materialize(trees, "merkle-trees")
    sizes = shares.join(trees.select("tree", "n"), "tree").select("tree", "part", "n", (F.col("prior") - F.col("first")).alias("shift"))
    leaves = ordered.join(sizes, ["part", "tree"]).select(
        "tree", (F.col("at") + F.col("shift")).alias("pos"), "n", F.expr(f"at div {block}").alias("block"), "doc_id", "leaf", "claimed"
    )
    bounds = trees.agg(F.max("n").alias("n"), F.max("trees").alias("trees")).first()
    levels = _upwards(leaves.withColumnRenamed("leaf", "hash"), bounds.n or 0)
    ground = leaves.select("tree", "pos", "n", F.col("leaf").alias("hash"), F.lit(0).alias("level"))
    nodes = reduce(DataFrame.unionByName, levels, ground)
    depth = F.array_min(F.filter(F.sequence(F.lit(0), F.lit(16)), lambda d: F.pow(F.lit(FAN), d) >= F.col("n")))
    roots = nodes.where((F.col("pos") == 0) & (F.col("level") == depth)).select("tree", "hash").join(trees, "tree")
    top = materialize(roots.select(F.lit(TOP).alias("tree"), F.col("place").alias("pos"), F.col("trees").alias("n"), "hash"), "merkle-subroots")
    upper = [top.withColumn("level", F.lit(0)), *_upwards(top, bounds.trees or 0)]
    return Manifest(leaves, reduce(DataFrame.unionByName, upper, nodes).select("tree", "level", "pos", "hash"), trees)


def missing_nodes(known: DataFrame, most: int) -> DataFrame:
    """``block, tree, level, pos``: the nodes next to the paths of a block's
    ``known`` ones (block, tree, pos, n: level 0) that these cannot give."""
    out, level = [], 0
    here = known.select("block", "tree", "n", "pos").distinct()
    while FAN**level < most:
        left = F.ceil(F.col("n") / F.lit(FAN**level)).cast("bigint")
        runs = (
            here.withColumn("left", left).where("left > 1")
            .groupBy("block", "tree", "n", "left", F.expr(f"pos div {FAN}").alias("run"))
            .agg(F.collect_set("pos").alias("have"))
        )
        whole = F.sequence(F.col("run") * FAN, F.least(F.col("run") * FAN + (FAN - 1), F.col("left") - 1))
        out.append(runs.select("block", "tree", F.lit(level).alias("level"), F.explode(F.array_except(whole, "have")).alias("pos")))
        here = runs.select("block", "tree", "n", F.col("run").alias("pos"))
        level += 1
    empty = here.limit(0).select("block", "tree", F.lit(0).alias("level"), "pos")
    return reduce(DataFrame.unionByName, out, empty)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _derive(known: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> list[dict[int, str]]:
    """Joined hashes of every run above the known nodes, level by level; the
    last entry holds the root alone."""
    levels, level = [], 0
    while n > 1:
        runs = {}
        for r in {p // FAN for p in known}:
            members = range(r * FAN, min(r * FAN + FAN, n))
            runs[r] = "".join([known.get(p) or fetched[level, p] for p in members])
        levels.append(runs)
        known, n, level = {r: _hash(s) for r, s in runs.items()}, -(-n // FAN), level + 1
    return [*levels, known]


def expand(leaves: list[tuple[str, int, int, str]], places: dict[str, tuple[int, int]], fetched: dict[str, dict[tuple[int, int], str]]) -> list[tuple[str, str, str, str, str]]:
    """(subroot, root, siblings, folded root) of each claimed leaf of a block.

    ``leaves``: (tree, pos, n, leaf, claimed); ``places``: position of each
    tree's subroot and number of trees; ``fetched``: the missing nodes.
    """
    own: dict[str, tuple[int, dict[int, str]]] = {}
    for tree, pos, n, leaf, _ in leaves:
        own.setdefault(tree, (n, {}))[1][pos] = leaf
    inner = {t: _derive(known, n, fetched.get(t, {})) for t, (n, known) in own.items()}
    subroots = {t: levels[-1][0] for t, levels in inner.items()}
    trees = next(iter(places.values()))[1]
    top = _derive({places[t][0]: h for t, h in subroots.items()}, trees, fetched.get(TOP, {}))
    root = top[-1][next(iter(top[-1]))] if trees > 1 else next(iter(subroots.values()))
    out = []
    for tree, pos, _, _, claimed in leaves:
        siblings, folded = [], claimed
        for runs, p in ((inner[tree][:-1], pos), (top[:-1], places[tree][0])):
            for level in runs:
                run, i = level[p // FAN], p % FAN
                left, right = run[: 64 * i], run[64 * i + 64 :]
                siblings += (left, right)
                folded = _hash(left + folded + right)
                p //= FAN
        out.append((subroots[tree], root, "".join(siblings), folded))
    return out


def prove(manifest: Manifest, siblings: bool = False) -> DataFrame:
    """One row per leaf: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified`` and, if asked for, the proof itself (``siblings``:
    the hashes of the run's others, level by level, 64 characters each).

    ``folded_root`` is folded from the claimed leaf and the original siblings.
    """
    leaves, nodes, trees = manifest.leaves, manifest.nodes, manifest.trees
    bounds = trees.agg(F.max("n").alias("n"), F.max("trees").alias("trees")).first()
    pairs = leaves.select("block", "tree").distinct().join(trees, "tree")
    tops = pairs.select("block", F.lit(TOP).alias("tree"), F.col("place").alias("pos"), F.col("trees").alias("n"))
    wanted = missing_nodes(leaves, bounds.n or 0).unionByName(missing_nodes(tops, bounds.trees or 0))
    fetched = wanted.join(nodes, ["tree", "level", "pos"]).select("block", "tree", "level", "pos", "hash", F.lit(0).cast("bigint").alias("trees"))
    about = pairs.select("block", "tree", F.lit(-1).alias("level"), F.col("place").alias("pos"), F.lit("").alias("hash"), F.col("trees").cast("bigint").alias("trees"))
    # New names: both sides of the cogroup come from the leaves.
    other_side = fetched.unionByName(about).select(*[F.col(c).alias(f"_{c}") for c in ("block", "tree", "level", "pos", "hash", "trees")])
    extra = [pa.field("siblings", pa.string())] if siblings else []
    kind = leaves.schema["doc_id"].dataType.simpleString()
    fixed = [pa.field(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]

    def run(own: pa.Table, other: pa.Table) -> pa.Table:
        places, nodes_of = {}, {}
        for tree, level, pos, hash_, trees_ in zip(*[other.column(c).to_pylist() for c in ("_tree", "_level", "_pos", "_hash", "_trees")], strict=True):
            if level < 0:
                places[tree] = (pos, trees_)
            else:
                nodes_of.setdefault(tree, {})[level, pos] = hash_
        got = expand(list(zip(*[own.column(c).to_pylist() for c in ("tree", "pos", "n", "leaf", "claimed")], strict=True)), places, nodes_of) if own.num_rows else []
        subroots, roots, proofs, folded = zip(*got) if got else ([], [], [], [])
        columns = [own.column("leaf"), pa.array(subroots, pa.string()), pa.array(roots, pa.string()), pa.array([_hash(s) for s in proofs], pa.string()), pa.array(folded, pa.string())]
        columns = [own.column("doc_id"), *columns, pa.array([a == b for a, b in zip(folded, roots, strict=True)], pa.bool_())]
        schema = [pa.field("doc_id", own.column("doc_id").type), *fixed, pa.field("verified", pa.bool_()), *extra]
        return pa.table(columns + ([pa.array(proofs, pa.string())] if siblings else []), schema=pa.schema(schema))

    result = RESULT.replace("doc_id long", f"doc_id {kind}") + (", siblings string" if siblings else "")
    return leaves.groupBy("block").cogroup(other_side.groupBy("_block")).applyInArrow(run, result)


def audit_documents(docs: DataFrame) -> DataFrame:
    """Proofs of all rows of ``docs``, tested with leaves in which the text of
    every row with ``crc32(doc_id) % 5 == 0`` has its A-Z lower-cased (a null
    text or id stays as it is)."""
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claim = F.when(marked, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return prove(build_manifest(docs, claim=claim))
