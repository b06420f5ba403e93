"""Corpus pipeline: five stages over ``documents``, each one operator.

quality rules -> exact dedup -> near-duplicate removal -> mixing sources to
target weights -> subword encoding.  A stage takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; ``run`` writes each result as Parquet to the shared folder
and hands the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm.exact_dedup import drop_copies
from hourglass.llm.mixing import repeat_documents
from hourglass.llm.quality import drop_rejected
from hourglass.llm.queries import MIX_WEIGHTS
from hourglass.llm.support import materialize, table

#: Links of the near-duplicate stage need this similarity in percent; the thin query op9 has its own bar.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the cascade."""
    return drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity of 0.8 or more)."""
    from hourglass.llm.near_dedup import drop_near_copies

    return drop_near_copies(docs, percent=NEAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled."""
    return repeat_documents(docs, MIX_WEIGHTS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    from hourglass.llm.pieces import encode_documents

    return encode_documents(docs)


#: (name, function) in order.
STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL cannot express near-duplicate components and encoding.  Near dedup is tested against all pairs on the
#: small table, rules, exact dedup and mixing by the twins of 6, 3 and 10, encoding by its round trip only.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
