"""Keyed merge of a new batch into current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK, NEW, HAS_NEW = "_rank", "_new", "_has_new"


def _guard_keys(df: DataFrame, key: str, null_keys: str) -> DataFrame:
    if null_keys == "error":
        return df.withColumn(
            key,
            F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null {key} in upsert batch"))).otherwise(
                F.col(key)
            ),
        )
    if null_keys == "drop":
        return df.where(F.col(key).isNotNull())
    if null_keys == "keep_one":
        return df
    raise ValueError("null_keys must be 'error', 'drop' or 'keep_one'")


def _order(cols: Sequence[str], order_cols: Sequence[str] | None, key: str) -> list[Column]:
    """Deterministic preference: caller's order, then all values."""
    first = list(order_cols or [])
    return [F.col(c) for c in (*first, *[c for c in cols if c != key and c not in first])] or [F.col(key)]


def dedupe_by_key(
    df: DataFrame, key: str = "key", order_cols: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order_cols`` (then by all values).

    Spark limits a window whose row number is filtered to 1 before the
    shuffle too, so each task sends one row per key at most, hot or not.
    """
    cols = df.columns
    w = Window.partitionBy(key).orderBy(*_order(cols, order_cols, key))
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) == 1).select(cols)


def upsert_by_key(
    current: DataFrame,
    new: DataFrame,
    key: str = "key",
    order_cols: Sequence[str] | None = None,
    update_cols: Sequence[str] | None = None,
    null_keys: str = "error",
    by_range: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """Merge ``new`` into ``current`` by ``key``.

    - key only in current: kept; only in new: inserted;
    - key in both: the whole row is replaced by the new one (default), or,
      with ``update_cols``, only those columns are taken from the new row
      and the others are kept;
    - a key several times in ``new``: the first by ``order_cols`` wins (ties
      broken by the remaining values, so the result is deterministic);
    - null keys: ``'error'`` (default; raised while the job runs), ``'drop'``,
      or ``'keep_one'``.

    The keys of ``current`` are unique (it is a table kept by this merge).
    Both inputs go through one shuffle and one sort, the new rows of a key
    before its current one, and each input is evaluated once.  Rows are dealt
    and sorted by a hash of the key first: keys of one month share a long
    prefix, which makes them slow to compare.  With ``by_range`` they are dealt
    into ranges of keys instead (for a writer that wants keys clustered; the
    inputs are then read a second time for the sample of keys), and with
    ``in_order`` they are sorted by the key itself (for one that sorts by it).
    """
    cols = current.columns
    fresh = _guard_keys(new.select(cols), key, null_keys).withColumn(NEW, F.lit(True))
    both = current.select(cols).withColumn(NEW, F.lit(False)).unionByName(fresh)
    if by_range:
        both = both.repartitionByRange(key)
    groups = [key] if in_order else [F.xxhash64(key), key]
    w = Window.partitionBy(*groups).orderBy(F.col(NEW).desc(), *_order(cols, order_cols, key))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = F.col(NEW) & (F.row_number().over(w) == 1)
    replaced = F.first(NEW).over(so_far)
    if not update_cols:
        ranked = both.select("*", chosen.alias(RANK), replaced.alias(HAS_NEW))
        return ranked.where(F.col(RANK) | ~F.col(HAS_NEW)).select(cols)

    # Partial update: a current row takes the update columns of its key's new
    # row; a new row is inserted only where there is no current one.
    alone = F.last(NEW).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    values = [
        F.when(replaced, F.first(c).over(so_far)).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
        for c in cols
    ]
    ranked = both.select(*values, NEW, (chosen & alone).alias(RANK))
    return ranked.where(F.col(RANK) | ~F.col(NEW)).select(cols)
