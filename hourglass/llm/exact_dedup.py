"""Exact deduplication in combining steps, DataFrame functions only.

1. Every task deduplicates its own rows (map side of the first aggregate).
2. Copies meet in salted groups (digest, whole text, salt of the id), so a
   text that holds a third of all rows is spread over ``SALTS`` groups.
3. The salt winners, at most ``SALTS`` rows a text, meet globally.

Every step groups by the whole normalised text next to its digest, so
different texts never join.  The way back to single documents carries no
text: it goes by (digest, salt), only to the salts that step 3 has seen.
Step 3 counts the texts behind each digest and fails if it ever finds two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.support import ascii_lower, text_of

#: Groups that one text is spread over; a bit of a long each, so 62 at most.
SALTS = 48


def normalised(text: "str | Column") -> Column:
    """The text as it is compared: null as empty, A-Z lower-cased."""
    return ascii_lower(text_of(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  Of equal texts the row with the largest id stays (null is below
    every id, so it stays only where a group has no other).  Rows that repeat
    both id and text are one document and give one row; each of them counts
    in ``group_size``.  An empty table gives no rows, very long texts are
    compared whole, and other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("_norm"))
    rows = rows.select(
        "doc_id", "_norm", F.sha2("_norm", 256).alias("_sha"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("_salt")
    )
    salted = rows.groupBy("_sha", "_norm", "_salt").agg(F.max("doc_id").alias("_max"), F.count(F.lit(1)).alias("_n"))
    texts = (
        salted.repartition("_sha")
        .groupBy("_sha", "_norm")
        .agg(
            F.max("_max").alias("_max"),
            F.sum("_n").alias("_n"),
            F.bit_or(F.expr("shiftleft(1L, cast(_salt as int))")).alias("_salts"),
        )
    )
    groups = (
        texts.groupBy("_sha")
        .agg(
            F.max("_max").alias("keep_id"), F.sum("_n").alias("group_size"), F.bit_or("_salts").alias("_salts"),
            F.count(F.lit(1)).alias("_texts"),
        )
        .filter(F.when(F.col("_texts") > 1, F.raise_error(F.lit("two texts share a digest")).cast("boolean")).otherwise(F.col("group_size") > 1))
    )
    seen = F.expr(f"filter(sequence(0L, {SALTS - 1}L), s -> getbit(_salts, cast(s as int)) = 1)")
    back = groups.select("_sha", F.explode(seen).alias("_salt"), "keep_id", "group_size")
    single = rows.select("_sha", "_salt", "doc_id").repartition("_sha", "_salt").distinct()
    out = single.join(back, ["_sha", "_salt"], "left")
    copies = F.col("group_size").isNotNull()
    keep = F.when(copies, F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    Rows that repeat an id and its text stay once (any of them).  The rows are
    found by (id, digest), both of which the result of ``exact_groups`` has.
    """
    # One key for the join and for the repeated rows, so that the texts are shuffled once for both.
    key = lambda ident, sha: F.concat_ws(":", sha, ident.cast("string"))
    stay = exact_groups(docs, id_col, text_col).filter("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias("_stay"))
    mine = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    rows = docs.select(key(F.col(f"`{id_col}`"), F.sha2(normalised(text_col), 256)).alias("_stay"), mine.alias("_row"))
    out = rows.join(stay, "_stay", "left_semi").dropDuplicates(["_stay"])
    return out.select(*[F.col(f"_row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
