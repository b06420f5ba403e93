"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate, so that the expected mix has the
target weights.  A document's count is the inverse of the Poisson
distribution function at a uniform number hashed from (seed, id): the same
document always gets the same count, on any cluster and after any retry.
Documents are then repeated by their count and shuffled globally by a hash.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.support import own_names, work_names

#: The most distinct sources whose rates are sent to every task; beyond it
#: the rates meet the documents in a join spread by salts.
BROADCAST_SOURCES = 10_000
SALTS = 64
#: Largest rate whose Poisson terms are summed from 0; exp(-rate) is 0 from about 745.
FROM_ZERO = 500


def uniform(seed: int, *keys: "str | Column") -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the keys."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_count(u: Column, rate: Column) -> Column:
    """Smallest k with P(Poisson(rate) <= k) > u; 0 for a rate of 0.

    The terms are summed up to ``rate + 12 sqrt(rate) + 30``, beyond which the
    tail is below the resolution of ``u``.  Above ``FROM_ZERO`` the sum starts
    at ``rate - 12 sqrt(rate) - 30``, as the terms near 0 underflow; what lies
    before it is below that resolution too.
    """
    wide = 12 * F.sqrt(rate) + 30
    far = rate > FROM_ZERO
    first = F.when(far, F.floor(rate - wide)).otherwise(F.lit(0)).cast("int")
    # log(rate^k exp(-rate) / k!) by Stirling's series, with the large terms taken off each other first.
    k, off = first.cast("double"), (first - rate) / rate
    stirling = 1 / (12 * k) - 1 / (360 * k * k * k) + F.log(2 * math.pi * k) / 2
    term = F.when(far, F.exp(-rate * ((1 + off) * F.log1p(off) - off) - stirling)).otherwise(F.exp(-rate))
    start = F.struct(term.alias("term"), term.alias("sum"), first.alias("k"), u.alias("u"), rate.alias("rate"))

    def step(a, k):
        term = a["term"] * a["rate"] / k
        return F.when(a["sum"] > a["u"], a).otherwise(
            F.struct(term.alias("term"), (a["sum"] + term).alias("sum"), k.alias("k"), a["u"].alias("u"), a["rate"].alias("rate"))
        )

    return F.aggregate(F.sequence(first + 1, F.ceil(rate + wide).cast("int")), start, step, lambda a: a["k"]).cast("long")


def rates(
    docs: DataFrame, weights: Mapping[str, float] | None, passes: float, source_col: str = "source", size: Column | None = None
) -> DataFrame:
    """``_source, rate``: mean repetitions per document of each source.

    ``rate = passes * all * weight / (sum of weights * size of the source)``;
    sizes are document counts, or sums of ``size``.  Sources without a given
    weight share weight 1 each; ``weights=None`` gives equal weights to all.  A null source is
    a source of its own, addressed by the key "" .
    """
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    per = docs.groupBy(name.alias("_source")).agg(F.sum(size if size is not None else F.lit(1)).cast("double").alias("_size"))
    weight = F.lit(1.0)
    if weights:
        if any(not w >= 0 or math.isinf(w) for w in weights.values()):
            raise ValueError("weights are numbers of at least 0")
        pairs = [x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.element_at(F.create_map(*pairs), F.col("_source")), F.lit(1.0))
    per = per.withColumn("_weight", weight)
    everything, weights_sum = per.select(F.sum("_size")).scalar(), per.select(F.sum("_weight")).scalar()
    share = everything * F.col("_weight") / F.nullif(weights_sum * F.col("_size"), F.lit(0.0))
    return per.select("_source", F.coalesce(F.lit(float(passes)) * share, F.lit(0.0)).alias("rate"))


#: Columns that :func:`mix_sources` adds.
ADDED = ("copy", "rate", "shuffle_key")


def _mixed(
    docs: DataFrame, weights: Mapping[str, float] | None, passes: float, seed: int, id_col: str, source_col: str
) -> DataFrame:
    """``docs``, whose names clash with none here, repeated and shuffled, plus the columns of ``ADDED``."""
    per = rates(docs, weights, passes, source_col)
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    rows = docs.withColumn("_source", name)
    sources = per.limit(BROADCAST_SOURCES + 1).count()
    if sources <= BROADCAST_SOURCES:
        rows = rows.join(F.broadcast(per), "_source")
    else:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
        spread = per.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rows = rows.join(spread, ["_source", "_salt"]).drop("_salt")
    count = poisson_count(uniform(seed, F.lit("count"), id_col), F.col("rate"))
    rows = rows.withColumn("_count", count).filter("_count > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_count"))))
    rows = rows.withColumn("shuffle_key", uniform(seed, F.lit("order"), id_col, "copy")).drop("_source", "_count")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.col("shuffle_key") * F.lit(parts)).cast("int")
    return rows.repartitionById(parts, place).sortWithinPartitions("shuffle_key", id_col, "copy")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    passes: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Every document repeated by its Poisson count, in a global shuffled order.

    Adds ``copy`` (1 .. count), ``rate`` and ``shuffle_key``, a uniform number
    hashed from (seed, id, copy); partition i of n holds the keys from i/n to
    (i + 1)/n, sorted, so one exchange shuffles globally without sampling.  A document may get no copy: that is the distribution.  Rows
    that repeat an id get the same count each; null ids share one number.
    Clashing columns of ``docs`` named ``copy``, ``rate`` or ``shuffle_key``
    are replaced.  An empty table gives no rows.
    """
    work, names = work_names(docs)
    mixed = _mixed(work, weights, passes, seed, names[id_col], names[source_col])
    return mixed.select(*own_names(names, ADDED), *ADDED)


def repeat_documents(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    passes: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """The same rows in the same order as :func:`mix_sources`, with the columns of
    ``docs`` alone, unchanged (also one called ``copy`` or ``rate``)."""
    work, names = work_names(docs)
    return _mixed(work, weights, passes, seed, names[id_col], names[source_col]).select(*own_names(names))
