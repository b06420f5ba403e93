"""Merkle manifest and proofs against a plain loop."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hourglass.llm.merkle import FIELDS, audit_documents, build_manifest, missing_nodes, prove

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string, block string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def upwards(hashes: list[str]) -> list[list[str]]:
    levels = [hashes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 16])) for i in range(0, len(low), 16)])
    return levels


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0], leaf_of(*r), r))
    order = lambda v: (v is not None, (v or "").encode() if not isinstance(v, int) else v)
    names = sorted(groups, key=order)
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda x: (order(x[0]), x[1]))
        trees[s] = (own, upwards([x[1] for x in own]))
    top = upwards([trees[s][1][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        own, levels = trees[s]
        for i, (doc_id, leaf, r) in enumerate(own):
            text = r[4]
            if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded, siblings = leaf_of(*r[:4], text), []
            for tree, p in ((levels, i), (top, j)):
                for level in tree[:-1]:
                    run, k = level[p // 16 * 16 : p // 16 * 16 + 16], p % 16
                    siblings += run[:k] + run[k + 1 :]
                    folded = sha("".join(run[:k]) + folded + "".join(run[k + 1 :]))
                    p //= 16
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], sha("".join(siblings)), folded, folded == top[-1][0]))
    return sorted(out, key=lambda x: tuple(map(str, x)))


def case(name: str) -> list[tuple]:
    if name == "hard":
        rows = [(i, ["a", None, "é", "", "n", "t"][i % 6], None if i % 3 else "en", i, [None, "", "Same TEXT", "x" * 50_000][i % 4]) for i in range(60)]
        return [*rows, rows[5], rows[5], (None, "a", None, None, "No id"), (None, None, None, None, None)]
    if name == "one row":
        return [(7, "s", "en", 3, "ABC")]
    if name == "one tree":
        return [(i, "s", "en", i, f"Text {i}") for i in range(300)]
    return [(i, f"s{i:03d}", "en", 1, "T") for i in range(40)] + [(1000 + i, "hot", "en", 1, f"T{i % 7}") for i in range(200)]


@pytest.mark.parametrize("name", ["hard", "one row", "one tree", "many trees"])
@pytest.mark.parametrize("block", [8, 4096])
def test_proofs(spark, name, block):
    rows = case(name)
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claim = F.when(marked, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    got = prove(build_manifest(docs, claim=claim, block=block)).collect() if block == 8 else audit_documents(docs).collect()
    assert sorted([tuple(r) for r in got], key=lambda x: tuple(map(str, x))) == plain(rows)


def test_empty(spark):
    assert audit_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_block_fetches_only_what_its_leaves_cannot_give(spark):
    """One tree of 300 leaves: a block of 64 aligned leaves needs no leaf and no
    run of its own, only the other runs' hashes; the whole needs nothing."""
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in case("one tree")], SCHEMA)
    m = build_manifest(docs)
    known = m.leaves.where("pos < 64").select(F.lit(1).alias("block"), "tree", "pos", "n")
    wanted = sorted((r.level, r.pos) for r in missing_nodes(known, 300).collect())
    assert wanted == [(1, p) for p in range(4, 16)] + [(2, 1)]
    assert missing_nodes(m.leaves.select(F.lit(1).alias("block"), "tree", "pos", "n"), 300).count() == 0
    assert len(FIELDS) == 5


def test_siblings_fold_to_the_root(spark):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in case("many trees")], SCHEMA)
    rows = prove(build_manifest(docs), siblings=True).collect()
    assert len(rows) == 240 and all(r.verified and sha(r.siblings) == r.proof_sha256 and len(r.siblings) % 64 == 0 for r in rows)
