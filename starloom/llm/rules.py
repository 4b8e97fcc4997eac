"""Quality rules (operator 5, native): a threshold table compiled into one
projection of built-in functions. No user functions, no shuffle: every figure
comes from the row's own text through array functions.

The row-wise steps are separate projections because each reuses its input
several times inside lambdas; the optimizer keeps such projections apart, so
word and window arrays are made once for each row.

A 3-word window is compared by the 64-bit XXH64 of its three words inside one
text. Edge cases: a null or empty text has no words, all figures are 0 and the
base test fails it; null ids and repeated rows are kept; very long texts cost
one sort of their windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that it was for on are as with be this by at from not "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par pas sur au plus "
    "de la que el en y a los se del las un por con no una su para es al"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; a bound of None does not apply."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Metrics are SQL over the base columns; a text passes if every rule holds.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 20.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.1),
    Rule("bangs_per_word", "n_bangs / n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("repeated_windows", "n_repeat_words / n_words", None, 0.3),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def base_figures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_stop_words, n_bangs) of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_t"))
    rows = rows.select(
        "doc_id",
        F.length(F.regexp_replace("_t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("_t") - F.length(F.translate("_t", "!", ""))).cast("long").alias("n_bangs"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.array_remove(F.split("_t", SPACE), "").alias("_words"),
    )
    stop = F.array(*[F.lit(x) for x in sorted({*STOP_WORDS})])
    rows = rows.select(
        "doc_id", "word_chars", "n_symbols", "n_bangs", "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_intersect(F.transform("_words", F.lower), stop)).cast("long").alias("n_stop_words"),
    )
    # windows as (hash, place), in order of the hash: equal ones are neighbours
    window = "sort_array(transform(sequence(0, cast(n_words as int) - 3), i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) as h, i as i)))"
    rows = rows.withColumn("_w", F.expr(f"if(n_words >= 3, {window}, cast(array() as array<struct<h: bigint, i: int>>))")).drop("_words")
    again = "filter(_w, (x, t) -> (t > 0 and x.h = _w[t - 1].h) or (t < size(_w) - 1 and x.h = _w[t + 1].h))"
    rows = rows.withColumn("_at", F.expr(f"sort_array(transform({again}, x -> x.i))")).drop("_w")
    covered = "aggregate(transform(_at, (x, t) -> if(t < size(_at) - 1, least(3, _at[t + 1] - x), 3)), 0L, (a, x) -> a + x)"
    return rows.withColumn("n_repeat_words", F.expr(covered)).drop("_at")


def passes(rules=RULES) -> Column:
    """The rule table as one boolean column; a text without words fails."""
    tests = [F.col("n_words") > 0]
    for r in rules:
        metric = F.expr(f"if(n_words > 0 and n_lines > 0, cast({r.metric} as double), 0)")
        tests += [metric >= r.low] if r.low is not None else []
        tests += [metric <= r.high] if r.high is not None else []
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def quality_rules(df: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base figures, ``base_failed`` and ``kept`` of each row."""
    figures = base_figures(df, id_col, text_col)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return figures.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passes(rules))
