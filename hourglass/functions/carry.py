"""Boundary exchange: rows in sorted ranges that hand their last rows on.

A frame is cut into ranges of its (series, time) order.  The cuts come from a
bounded sample of the rows -- those of the least hash, so they are the same for
every task and attempt --, and stand in the plan as literals: the range of a row
is a function of its own keys.  Any cuts give right results; the sample only
makes the ranges even, however long or hot a series is.  A window per (series,
range) then sees all it needs once each range gets the last rows that earlier
ranges hold of its series.  Only the series that a cut falls into, at most one
per cut, have anything to hand on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.grid import BUCKET_COL, HALO_COL

#: Sampled rows per range; at most this many times the ranges reach the driver.
SAMPLE = 16
MOST_RANGES = 1 << 14


def search_sorted(values: Column, key: Column, most: int = MOST_RANGES) -> Column:
    """How many elements of the sorted array ``values`` (at most ``most``) are
    not above ``key``: a binary search by expression."""
    steps = [1 << k for k in reversed(range(most.bit_length()))]

    def go(at: Column, step: Column) -> Column:
        # A place behind the end gives null, which is not true.
        return F.when(F.get(values, at + step - 1) <= key, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), go)


def range_cuts(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> list[tuple]:
    """At most ``ranges - 1`` keys (as text) that cut ``df`` into even ranges of
    ``order``; from ``SAMPLE`` sampled rows per range."""
    n = min(ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    keys = df.select(*order)
    drawn = keys.orderBy(F.xxhash64(*order, F.lit(7)), *order).limit(n * SAMPLE)
    rows = drawn.orderBy(*order).select(*[F.col(c).cast("string") for c in order]).collect()
    step = max(1, -(-len(rows) // n))
    return list(dict.fromkeys(tuple(r) for r in rows[step::step]))


def range_of(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> Column:
    """Number of the range that a row of ``df`` is in."""
    if not cuts:
        return F.lit(0).cast("long")
    kinds = [df.schema[c].dataType for c in order]
    values = F.array(*[F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(cut, kinds, order, strict=True)]) for cut in cuts])
    return search_sorted(values, F.struct(*[F.col(c) for c in order]), len(cuts)).cast("long")


def _in_cut_series(df: DataFrame, by: Sequence[str], cuts: list[tuple]) -> Column:
    """Whether a cut falls into the row's series."""
    names = list(dict.fromkeys(cut[: len(by)] for cut in cuts))
    text = F.struct(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by])
    wanted = [F.struct(*[F.lit("-" if v is None else f"={v}") for v in name]) for name in names]
    return F.array_contains(F.array(*wanted), text) if wanted else F.lit(False)


def with_carry(
    df: DataFrame,
    by: "str | Sequence[str]",
    ds: str,
    size: int,
    handed: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` plus ``_bucket`` (its range) and ``_halo``, and for each range the
    last ``size`` rows (of those where ``handed`` holds) that earlier ranges have
    of the same series, as halo rows.

    Windows per (series, ``_bucket``) in ``ds`` order then see the ``size`` rows
    before each own row, as windows per series would.  A range with few rows of
    a series passes on what it was handed.
    """
    by = [by] if isinstance(by, str) else list(by)
    cuts = range_cuts(df, [*by, ds], ranges)
    own = df.withColumns({BUCKET_COL: range_of(df, [*by, ds], cuts), HALO_COL: F.lit(False)})
    if not cuts:
        return own
    columns = [F.col(c) for c in df.columns]
    gives = F.lit(True) if handed is None else F.coalesce(handed, F.lit(False))
    last = Window.partitionBy(*by, BUCKET_COL, "_gives").orderBy(F.col(ds).desc())
    crossing = own.where(_in_cut_series(df, by, cuts)).withColumn("_gives", gives)
    ends = crossing.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= size)
    row = F.when(F.col("_gives"), F.struct(F.col(ds).alias("_at"), (-F.col("_r")).alias("_r"), F.struct(*columns).alias("row")))
    tails = ends.groupBy(*by, BUCKET_COL).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    # One row per series that a cut falls into: its ranges, each with `size` rows at most.
    chain = tails.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(BUCKET_COL).alias("to"), "rows"))).alias("_chain"))
    start = F.struct(F.slice(F.col("_chain")[0]["rows"], 1, 0).alias("held"), F.slice("_chain", 1, 0).alias("out"))

    def pass_on(state: Column, part: Column) -> Column:
        both = F.concat(state["held"], part["rows"])
        held = F.when(F.size(both) > size, F.slice(both, -size, size)).otherwise(both)
        return F.struct(held.alias("held"), F.concat(state["out"], F.array(F.struct(part["to"].alias("to"), state["held"].alias("rows")))).alias("out"))

    handed_on = chain.select(F.explode(F.aggregate("_chain", start, pass_on)["out"]).alias("_o"))
    halo = handed_on.select(F.col("_o.to").alias(BUCKET_COL), F.explode("_o.rows").alias("_h"))
    halo = halo.select("_h.row.*", BUCKET_COL, F.lit(True).alias(HALO_COL))
    return own.unionByName(halo)


def last_of_series(df: DataFrame, by: "str | Sequence[str]", ds: str, size: int, value: Column, ranges: int | None = None) -> DataFrame:
    """Per series: ``_hist`` (the last ``size`` values, oldest first), ``_last``
    (the newest ``ds``) and ``_n`` (rows); no task sorts more than a range."""
    by = [by] if isinstance(by, str) else list(by)
    cuts = range_cuts(df, [*by, ds], ranges)
    own = df.select(*by, ds, value.alias("_v"), range_of(df, [*by, ds], cuts).alias(BUCKET_COL))
    newest = Window.partitionBy(*by, BUCKET_COL).orderBy(F.col(ds).desc())
    ends = own.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= size)
    pairs = F.sort_array(F.collect_list(F.struct(F.col(ds).alias("at"), (-F.col("_r")).alias("r"), F.col("_v").alias("v"))))
    values = F.transform(pairs, lambda e: e["v"])
    tails = ends.groupBy(*by).agg(F.max(ds).alias("_last"), values.alias("_all"))
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    held = F.when(F.size("_all") > size, F.slice("_all", -size, size)).otherwise(F.col("_all"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    return tails.alias("t").join(counts.alias("c"), same).select(*[F.col(f"t.{c}") for c in by], "_last", "_n", held.alias("_hist"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: "str | Sequence[str]",
    left_on: str,
    right_on: str,
    values: Sequence[str],
    ranges: int | None = None,
) -> DataFrame:
    """Rows of ``left`` with the ``values`` of the newest row of ``right`` of the
    same ``by`` at or before them (null if there is none).

    Both sides are united and cut into ranges; inside a range the last value is
    carried forward by a window, across ranges by the boundary exchange.  Nothing
    is broadcast and no pairs are formed.  Of right rows with equal keys any one
    is taken; right rows without a time match nothing.
    """
    by = [by] if isinstance(by, str) else list(by)
    names = [f"k{i}" for i in range(len(by))]
    mine = F.struct(*[F.col(c) for c in left.columns])
    theirs = F.struct(*[F.col(c) for c in values])
    known = right.where(F.col(right_on).isNotNull())
    a = left.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col(left_on).alias("at"), F.lit(1).alias("side"), mine.alias("mine"))
    b = known.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col(right_on).alias("at"), F.lit(0).alias("side"), theirs.alias("theirs"))
    both = with_carry(a.unionByName(b, allowMissingColumns=True), names, "at", 1, F.col("side") == 0, ranges)
    w = Window.partitionBy(*names, BUCKET_COL).orderBy("at", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("_found", F.last("theirs", ignorenulls=True).over(w)).where((F.col("side") == 1) & ~F.col(HALO_COL))
    return out.select("mine.*", *[F.col(f"_found.{c}").alias(c) for c in values])
