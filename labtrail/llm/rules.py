"""Quality rules: one table of thresholds, compiled into one projection of built-in functions.

`measures` adds the figures of a text, `judge` adds the verdicts of a threshold table. Null and empty texts
have no words, symbols or lines: their figures are 0 and they fail the base. Ratios with nothing to divide
by are 0. Every row is judged by itself, so repeated rows get the same verdict; columns that are named like
a result are replaced by it. Texts of any length are taken whole; equal five-word windows are found by
sorting their 64-bit hashes within the row. An empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import query, table, words_of

SYMBOLS = "#*$%&|<>"
# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be by this from at or an have not"
    " le la les de des du et un une que qui est pas pour dans en au sur"
    " der die das und ist nicht ein eine zu den von mit auf für im dem"
    " el los las y se del una por con no su para al lo"
).split()


class Rule(NamedTuple):
    """Pass while low <= measure <= high; a bound of None does not bind, nor do shorter texts than from_words."""

    name: str
    measure: str
    low: float | None
    high: float | None
    from_words: int = 0


THRESHOLDS = (
    Rule("word_length", "mean_word_chars", 1.5, 20.0),
    Rule("symbols", "symbol_ratio", None, 0.3),
    Rule("stop_words", "stop_ratio", 0.02, None, 50),
    Rule("bar_lines", "bar_ratio", None, 0.3),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
)


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _covered(starts: Column, width: int) -> Column:
    """How many words windows of `width` at these ascending starts cover."""
    steps = F.zip_with(
        F.slice(starts, F.lit(2), F.size(starts)),
        F.slice(starts, F.lit(1), F.greatest(F.size(starts) - 1, F.lit(0))),
        lambda later, earlier: F.least(later - earlier, F.lit(width)),
    )
    return F.when(F.size(starts) > 0, F.aggregate(steps, F.lit(width), lambda acc, x: acc + x)).otherwise(F.lit(0))


def measures(docs: DataFrame, text: str = "text", window: int = 5) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and the ratios."""
    own = [
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "mean_word_chars",
        "symbol_ratio", "stop_ratio", "bar_ratio", "dup_line_ratio",
    ]
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c.lower() not in own]
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(
        *kept,
        words_of(body).alias("__words"),
        lines.alias("__lines"),
        F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).alias("__symbols"),
        (F.length(body) - F.length(F.replace(body, F.lit("|"), F.lit("")))).alias("__bars"),
    )
    hashed = split.select(
        *kept,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.col("__symbols").cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("__stops"),
        "__bars",
        F.when(
            F.size("__words") > window,
            F.transform(
                F.sequence(F.lit(1), F.size("__words") - window + 1),
                lambda i: F.xxhash64(*[F.get(F.col("__words"), i + k) for k in range(-1, window - 1)]),
            ),
        ).alias("__windows"),
    )
    # Only texts in which some window comes twice have their windows sorted.
    twice = F.size(F.array_distinct("__windows")) < F.size("__windows")
    ordered = hashed.withColumn(
        "__windows",
        F.when(
            twice, F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ),
    )
    w = F.col("__windows")
    repeats = F.filter(
        w,
        lambda x, i: ((i > 0) & (F.try_element_at(w, F.greatest(i, F.lit(1)))["h"] == x["h"]))
        | F.coalesce(F.try_element_at(w, i + 2)["h"] == x["h"], F.lit(False)),
    )
    starts = ordered.withColumn("__windows", F.array_sort(F.transform(repeats, lambda x: x["i"])))
    counted = starts.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "__stops", "__bars",
        F.coalesce(_covered(F.col("__windows"), window), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return counted.select(
        *kept, *own[:6],
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbol_ratio"),
        _ratio("__stops", "n_words").alias("stop_ratio"),
        _ratio("__bars", "n_words").alias("bar_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
    )


def judge(measured: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS, min_words: int = 10, max_repeat: int = 20) -> DataFrame:
    """`measured` with base_failed, `failed` (names of the broken rules, in table order) and kept."""

    def broken(rule: Rule) -> Column:
        value, out = F.col(rule.measure), F.lit(False)
        if rule.low is not None:
            out = out | (value < rule.low)
        if rule.high is not None:
            out = out | (value > rule.high)
        return F.when(out & (F.col("n_words") >= rule.from_words), F.lit(rule.name))

    n = F.col("n_words")
    base = (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat * n)
    failed = F.array_compact(F.array(*map(broken, rules))) if rules else F.array().cast("array<string>")
    kept = [c for c in measured.columns if c.lower() not in ("base_failed", "failed", "kept")]
    judged = measured.select(*kept, base.alias("base_failed"), failed.alias("failed"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


OP3_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), spots AS (
  SELECT doc_id, i, words[i:i + 4] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM texts WHERE len(words) > 5)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM spots) WHERE c > 1
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(later - i, 5))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM again) GROUP BY doc_id
), counted AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda w: lower(w) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS stops,
         length(body) - length(replace(body, '|', '')) AS bars
  FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 20.0 * n_words
       AND n_symbols / n_words <= 0.3 AND (n_words < 50 OR stops / n_words >= 0.02) AND bars / n_words <= 0.3
       AND n_dup_lines / n_lines <= 0.5 AS kept
FROM judged
"""


@query("op3_quality_rules", OP3_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(measures(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
