"""Quality rules as a short-circuit cascade, DataFrame functions only.

Counts come from array functions over the words of one text.  The rules of
the cascade are SQL conditions; on a bounded hash sample each rule's cost
(seconds) and selectivity (share rejected) are measured, and the rules run in
the order of rejection per cost inside one CASE, so a text rejected by an
early rule never pays for a later one.  The order changes the cost only,
never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.support import materialize, own_names, text_of, work_names

#: Documents (about) on which rules are timed; only the order depends on it.
SAMPLE_DOCS = 1000
_WS = r"[\x20\x09-\x0D]+"
#: The symbols that the contract counts.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """``reject``: SQL over ``_text``, ``_words``, ``_lines`` and the base counts."""

    name: str
    reject: str


#: The rules of the cascade; thresholds leave room around ordinary prose.
RULES: tuple[Rule, ...] = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "size(_lines) > 1 and 2 * n_dup_lines > size(_lines)"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("exclamations", "3 * (length(_text) - length(replace(_text, '!', ''))) > n_words"),
    Rule("digits", r"3 * regexp_count(_text, '[0-9]') > word_chars"),
    Rule("capitals", r"3 * regexp_count(_text, '\\p{Lu}') > word_chars"),
    Rule("letterless_words", r"10 * size(filter(_words, w -> not w rlike '\\p{L}')) > 3 * size(_words)"),
    Rule("bullet_lines", r"size(_lines) > 4 and 10 * size(filter(_lines, x -> x rlike '^\\s*[-*•]')) > 9 * size(_lines)"),
)


#: Words under 3-word windows found twice or more.  ``let x = e in f`` is written
#: ``transform(array(e), x -> f)[0]``, so that no lambda evaluates ``e`` again.
#: The windows are sorted with their places, equal neighbours mark windows
#: found twice or more, and one pass over the marked places counts the words.
_REPEATED = """
aggregate(
  transform(array(
    transform(array(_words), w ->
      sort_array(if(size(w) < 3, array(), transform(sequence(0, size(w) - 3),
        i -> named_struct('w', concat_ws(' ', w[i], w[i + 1], w[i + 2]), 'at', i)))))[0]
  ), s -> sort_array(transform(
    filter(
      arrays_zip(s, concat(array(cast(null as struct<w:string, at:int>)), s), slice(s, 2, greatest(size(s), 1))),
      z -> z.s is not null and (z.s.w = z.`1`.w or z.s.w = z.`2`.w)),
    z -> z.s.at)))[0],
  named_struct('to', 0, 'n', 0L),
  (a, p) -> named_struct('to', p + 3, 'n', a.n + (p + 3 - greatest(p, a.to))),
  a -> a.n)
"""


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_text, _words, _lines`` and the base counts."""
    df = docs.withColumn("_text", text_of(text_col))
    df = df.withColumns(
        {
            "_words": F.filter(F.split("_text", _WS), lambda w: w != ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    return df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.expr(_REPEATED),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, else null; later rules are not run."""
    out = F.when(F.lit(False), F.lit(""))
    for r in rules:
        out = out.when(F.coalesce(F.expr(r.reject), F.lit(False)), F.lit(r.name))
    return out


def plan_cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) in the order of rejection per cost.

    Measured on the documents whose id hash falls in the first
    ``sample_docs / count`` of the hash range.  With an empty sample the
    rules keep their given order.
    """
    total = docs.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    share = min(1.0, sample_docs / total)
    pick = F.pmod(F.xxhash64(F.col(id_col), F.lit("rules")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    sample = materialize(with_counts(docs.filter(pick).select(id_col, text_col), text_col), "rules")
    flags = [F.avg(F.expr(r.reject).cast("double")).alias(r.name) for r in rules]
    rejected = sample.agg(*flags).first().asDict()
    found = []
    for r in rules:
        began = time.perf_counter()
        sample.agg(F.count_if(F.expr(r.reject))).collect()
        found.append((r, max(time.perf_counter() - began, 1e-3), float(rejected[r.name] or 0.0)))
    return sorted(found, key=lambda x: (-x[2] / x[1], x[1], x[0].name))


#: Columns that :func:`assess` adds.
VERDICT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept")


def _assessed(work: DataFrame, rules: Sequence[Rule], id_col: str, text_col: str) -> DataFrame:
    """``work``, whose names clash with none here, plus the columns of ``VERDICT``."""
    ordered = [r for r, _, _ in plan_cascade(work, rules, id_col, text_col)]
    df = with_counts(work, text_col).withColumn("base_failed", base_failed())
    df = df.withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(ordered)))
    return df.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def assess(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` plus the base counts, ``base_failed``, ``rejected_by`` (null
    when no rule of the cascade rejects) and ``kept``.

    A null or empty text has no words, fails the base and is not kept.  Every
    row is assessed on its own: repeated rows, null ids and other columns pass
    through, whatever their names; those called like a column of the verdict
    are replaced by it.  An empty table gives no rows.
    """
    work, names = work_names(docs)
    return _assessed(work, rules, names[id_col], names[text_col]).select(*own_names(names, VERDICT), *VERDICT)


def drop_rejected(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their own columns unchanged
    (also one called ``kept`` or ``n_words``)."""
    work, names = work_names(docs)
    return _assessed(work, rules, names[id_col], names[text_col]).filter("kept").select(*own_names(names))
