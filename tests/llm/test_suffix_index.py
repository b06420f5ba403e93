"""Removal of repeated byte strings against a count of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hourglass.llm.suffix_index import SuffixFamily, anchors, remove_repeats, spread_of
from hourglass.llm.spans import join_documents

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row string, kept string, n_bytes string"


def plain(docs, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and the kept bytes, from a count of every string."""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def run(spark, docs, length, batches=3):
    frame = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in docs], SCHEMA).repartition(3)
    got = remove_repeats(frame, length=length, batches=batches, keep_text=True).collect()
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got], key=str)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in remove_repeats(spark.read.parquet(f"{SF}/documents.parquet")).collect()], key=str)
    want = [r[:5] for r in plain(docs, 400)]
    assert got == want and sum(r[2] for r in want) > 0


@pytest.mark.parametrize("length", [24, 40])
def test_random_matches(spark, length):
    """Copies, shifted and overlapping passages, runs of one letter, edits, matches of just the length and one less."""
    rng = random.Random(length)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    passage, exact, short = word(120), word(200).encode()[:length].decode(errors="ignore"), word(200)[: length // 2]
    docs = [(i, word(rng.randrange(0, 300))) for i in range(25)]
    docs += [(100 + i, word(30) + passage[rng.randrange(60) :] + word(rng.randrange(40))) for i in range(12)]
    docs += [(200 + i, word(17) + exact + word(i)) for i in range(2)] + [(210 + i, word(9) + short + word(9)) for i in range(4)]
    docs += [(300, "x" * 150), (301, "y" * (length - 1)), (302, "z" * length), (303, "ab" * 80), (304, None), (305, ""), (None, passage), (306, passage * 3)]
    docs += [(400, docs[3][1] * 2), (400, docs[3][1] * 2), (401, "é" * 3000), (402, passage[:50] + "!" + passage[51:])]
    assert run(spark, docs, length) == plain(docs, length)


def test_nothing_repeats_and_no_rows(spark):
    docs = [(1, "abc"), (2, "".join(chr(97 + (i * i + i // 7) % 26) for i in range(60))), (3, None)]
    assert run(spark, docs, 40) == plain(docs, 40)
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_anchors_depend_on_the_string_alone():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 101, 3000).astype(np.uint8).tobytes()
    buf, at = join_documents([text, text[500:1700], b"zz" + text[900:1500]])
    doc, place, first, last = anchors(buf, at, 400)
    where = {(d, s - at[d]): p - s for d, p, f, t in zip(doc, place, first, last, strict=True) for s in range(f, t + 1)}
    assert all(where[0, 500 + k] == where[1, k] for k in range(801))
    assert all(where[0, 900 + k] == where[2, 2 + k] for k in range(201)) and spread_of(400) == 256


def test_family_meets_later_batches_and_merges_geometrically(spark):
    family, met = SuffixFamily(), []
    for k in range(5):
        batch = spark.createDataFrame([(c, c) for c in range(10 * k, 10 * k + 11)] + [(1000 + k, 1)] * 2, "head long, core long")
        met.append({(r.head, r.core) for r in family.add(batch).collect()})
    assert met == [{(1000, 1)}, *[{(10 * k, 10 * k), (1000 + k, 1)} for k in range(1, 5)]]
    family.settle()
    assert {level: t.read().count() for level, t in family.levels.items()} == {0: 12, 2: 41 + 4}
    family.remove()
