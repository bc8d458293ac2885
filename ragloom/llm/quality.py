"""Quality rules as a short-circuit cascade (JVM expressions only).

Each rule is one self-contained Column over the text. Its cost (seconds per document) and its
selectivity (share rejected) are estimated on a bounded sample; the rules are then ordered by
rejection per cost, and one lazy CASE stops at the first rule that rejects a document. The order
changes the work, never the verdict.

Defined results: a null text has no words; a document that any rule rejects is not kept, an empty
one included; repeated rows are judged one by one; an empty table gives an empty result; columns
beside ``doc_id`` and ``text`` are left alone.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import let, materialize, words_of

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_pct: int = 50       # words inside repeated 3-word windows, of all words
    max_symbol_pct: int = 20       # symbol characters per 100 words
    max_dup_line_pct: int = 50     # repeated lines, of the lines with a word
    max_upper_pct: int = 60        # capitals A-Z, of the letters A-Z and a-z
    sample_docs: int = 1000        # bound of the sample for the cascade order


def symbol_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({SYMBOLS})"), F.lit(1))).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def dup_line_count(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def sorted_windows(words: Column) -> Column:
    """All 3-word windows with their position, sorted: equal windows become neighbours."""
    n = F.greatest(F.size(words) - 2, F.lit(0))
    zipped = F.arrays_zip(F.slice(words, F.lit(1), n).alias("a"), F.slice(words, F.lit(2), n).alias("b"),
                          F.slice(words, F.lit(3), n).alias("c"))
    return F.sort_array(F.transform(zipped, lambda x, i: F.struct(
        x["a"].alias("a"), x["b"].alias("b"), x["c"].alias("c"), i.alias("i"))))


def _neighbours(windows: Column) -> Column:
    """Positions of windows that equal their neighbour in the sorted array, ascending."""
    n = F.greatest(F.size(windows) - 1, F.lit(0))
    pairs = F.filter(
        F.arrays_zip(F.slice(windows, F.lit(1), n).alias("x"), F.slice(windows, F.lit(2), n).alias("y")),
        lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]))
    return F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p["x"]["i"], p["y"]["i"])))))


def repeat_word_count(windows: Column) -> Column:
    """Words covered by a 3-word window that occurs at least twice (from the sorted windows)."""
    return F.aggregate(
        _neighbours(windows), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"])


def upper_pct_over(text: Column, pct: int) -> Column:
    t = F.coalesce(text, F.lit(""))
    upper = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]", ""))
    letters = F.length(t) - F.length(F.regexp_replace(t, "[A-Za-z]", ""))
    return upper * 100 > letters * pct


def rules(text: Column, p: QualityParams = QualityParams()) -> dict[str, Column]:
    """Rule name -> Column that is true for a rejected document; each stands alone."""
    few = F.size(words_of(text)) < p.min_words
    repeated = let(words_of(text), lambda w: let(sorted_windows(w), repeat_word_count) * 100 > F.size(w) * p.max_repeat_pct)
    symbols = symbol_count(text) * 100 > F.size(words_of(text)) * p.max_symbol_pct
    dup_lines = let(lines_with_words(text), lambda ls: dup_line_count(ls) * 100 > F.size(ls) * p.max_dup_line_pct)
    return {"few_words": few, "repeated_windows": repeated, "symbols": symbols, "dup_lines": dup_lines,
            "capitals": upper_pct_over(text, p.max_upper_pct)}


def cascade_order(docs: DataFrame, p: QualityParams = QualityParams()) -> list[str]:
    """Rule names by estimated rejection per cost, highest first, from at most ``p.sample_docs`` documents.

    The sample is drawn by row at random over all partitions, written once, and each rule is timed on it."""
    texts = docs.select("text")
    total = texts.count()
    if total == 0:
        return list(rules(F.col("text"), p))
    fraction = min(1.0, 2.0 * p.sample_docs / total)
    sample = materialize(texts.sample(fraction, seed=7).limit(p.sample_docs).coalesce(2))
    ranked = []
    for name, rule in rules(F.col("text"), p).items():
        began = time.perf_counter()
        n, rejected = sample.agg(F.count(F.lit(1)), F.sum(rule.cast("long"))).first()
        cost = (time.perf_counter() - began) / max(n, 1)
        ranked.append((-((rejected or 0) / max(n, 1)) / max(cost, 1e-9), cost, name))
    return [name for _, _, name in sorted(ranked)]


def first_failed(text: Column, order: list[str], p: QualityParams = QualityParams()) -> Column:
    """Name of the first rule of ``order`` that rejects the text, or null. CASE is lazy: later rules don't run."""
    by_name = rules(text, p)
    out = F.when(by_name[order[0]], F.lit(order[0]))
    for name in order[1:]:
        out = out.when(by_name[name], F.lit(name))
    return out


def filter_quality(docs: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """The documents that no rule rejects, all columns unchanged."""
    return docs.filter(first_failed(F.col("text"), cascade_order(docs, p), p).isNull())


def quality_report(docs: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """Per row: doc_id, the base measures, base_failed, and kept by the cascade.

    The measures are wanted for every row, so the cascade runs over them as columns and keeps its
    order for the rules that read the text beyond them."""
    order = cascade_order(docs, p)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", words_of(F.col("text")).alias("words"), lines_with_words(F.col("text")).alias("lines"))
    w = F.col("words")
    measured = base.select(
        "doc_id", "text", F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        symbol_count(F.col("text")).alias("n_symbols"), dup_line_count(F.col("lines")).alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"), sorted_windows(w).alias("windows"))
    # read twice, so that the sorted array stays a projection of its own
    measured = measured.select("*", F.when(F.size("windows") > 1, repeat_word_count(F.col("windows")))
                               .otherwise(F.lit(0).cast("long")).alias("n_repeat_words")).drop("windows")
    n, rep = F.col("n_words"), F.col("n_repeat_words")
    rule = {"few_words": n < p.min_words, "repeated_windows": rep * 100 > n * p.max_repeat_pct,
            "symbols": F.col("n_symbols") * 100 > n * p.max_symbol_pct,
            "dup_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * p.max_dup_line_pct,
            "capitals": upper_pct_over(F.col("text"), p.max_upper_pct)}
    failed = F.when(rule[order[0]], F.lit(order[0]))
    for name in order[1:]:
        failed = failed.when(rule[name], F.lit(name))
    base_failed = (n < 50) | (rep * 100 > n * 50)
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), failed.alias("failed_rule")
    ).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT row_number() OVER () AS rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i:i+2] AS tri FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS n FROM g),
r AS (SELECT rid, count(DISTINCT j) AS n_rep FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY rid),
m AS (SELECT w.rid, doc_id, t, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(n_rep, 0)::BIGINT AS n_repeat_words,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
             length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters
      FROM w LEFT JOIN r USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 100 > n_words * 20
            OR n_dup_lines * 100 > n_lines * 50 OR n_upper * 100 > n_letters * 60) AS kept
FROM m
"""
