"""Registered queries of this subpackage: ``opN_<name>(spark, sf_dir)``.

Each applies one operator, with production parameters, to its whole table.
``ORACLE_SQL`` holds the DuckDB twins of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm.exact_dedup import exact_groups
from hourglass.llm.html_text import extract_pages
from hourglass.llm.lm import score_documents
from hourglass.llm.merkle import audit_documents
from hourglass.llm.mixing import mix_sources
from hourglass.llm.pieces import encode_documents
from hourglass.llm.quality import assess
from hourglass.llm.near_dedup import near_components
from hourglass.llm.secrets import scan_secrets
from hourglass.llm.suffix_index import remove_repeats
from hourglass.llm.support import table
from hourglass.llm.token_files import tokenise_documents
from hourglass.llm.warc import archive_pages
from hourglass.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Target weights of the mix: one source counts four times, all others once.
MIX_WEIGHTS = {"src0": 4.0}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assess(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), MIX_WEIGHTS).drop("rate")


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenise_documents(table(spark, sf_dir, "documents"))


@query
def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
