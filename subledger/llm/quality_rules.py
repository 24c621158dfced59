"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rules drop short and repetitive texts. Each further rule rejects a text
whose rate exceeds a cutoff, and the cutoffs are chosen on labelled holdouts
(good texts, none of which any rule was fitted on: the steps are fixed
beforehand). A step sets all rules' cutoffs at once, from lenient to strict. In
each stratum (language), the steps are tested in this fixed sequence: a step is
admitted if the exact binomial test rejects "the cutoffs drop more than RISK of
the good texts" at level ALPHA / strata, and every step before it was. Counts
can only rise along the steps, so the strictest admitted step is the end of the
sequence, and no further correction is due within a stratum. So with
probability 1 - ALPHA, in every stratum at once, the cutoffs together drop at
most RISK of the good texts. What the base rules drop is not part of this: they
are no choice of the method. A stratum with too few labels (some 85 good ones,
if no cutoff drops any) gets no cutoffs, only the base rules.

Defined results: a null or empty text has no words and fails the base rules;
languages that are null or not two or three lower-case letters form one
stratum, so there are at most 26**2 + 26**3 + 1; keys whose labels disagree
or are null are left out; rows of a repeated key are judged alike and each
counts as a holdout; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import bind, checkpointed, table

RISK, ALPHA = 0.05, 0.05

#: Rules and their cutoffs, from lenient to strict: a text fails if its rate is above. A step takes of each
#: rule the cutoff at its share of the way.
GRIDS = {
    "symbol_rate": (0.5, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02),
    "dup_line_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_rate": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "upper_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "chars_per_word": (60.0, 40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0),
}

STEPS = [{rule: grid[step * len(grid) // 10] for rule, grid in GRIDS.items()} for step in range(10)]

SPACE, SYMBOLS, CAPITALS = " \\t-\\r", "#*$%&|<>", "A-Z"


def _count(text: Column, characters: str) -> Column:
    """How many of a text's characters lie in a class."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("long")


def repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more.

    Windows are sorted by hash within the row's own array; equal neighbours
    are repeats, and the places they cover are counted from their starts.
    """
    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, k: F.least(F.lit(3), x - F.get(starts, k - 1)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def repeats(grams: Column) -> Column:
        twins = F.transform(grams, lambda x, k: bind(F.get(grams, k + 1), lambda y: F.when(y["h"] == x["h"], F.array(x["i"], y["i"]))))
        return bind(F.sort_array(F.flatten(F.filter(twins, lambda x: x.isNotNull()))), covered)

    places = F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0)))
    grams = F.transform(places, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bind(F.sort_array(grams), repeats)).cast("long")


def measures(text: Column, lang: Column) -> Column:
    """A struct of stratum, base counts, the rules' rates and base_failed of a whole text."""
    text = F.coalesce(text, F.lit(""))
    rate = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    counted = F.struct(
        bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeats"))).alias("words"),
        bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("repeats"))).alias("lines"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("chars"), _count(text, SYMBOLS).alias("symbols"), _count(text, CAPITALS).alias("capitals"))

    def rated(x: Column) -> Column:
        n, repeats = x["words"]["n"], x["words"]["repeats"]
        return F.struct(
            F.when(lang.rlike("^[a-z]{2,3}$"), lang).otherwise("other").alias("stratum"), n.alias("n_words"), x["chars"].alias("word_chars"), x["symbols"].alias("n_symbols"),
            x["lines"]["repeats"].alias("n_dup_lines"), repeats.alias("n_repeat_words"), rate(x["symbols"], x["chars"]).alias("symbol_rate"),
            rate(x["lines"]["repeats"], x["lines"]["n"]).alias("dup_line_rate"), rate(repeats, n).alias("repeat_rate"), rate(x["capitals"], x["chars"]).alias("upper_rate"),
            rate(x["chars"], n).alias("chars_per_word"), ((n < 50) | (100 * repeats > 50 * n)).alias("base_failed"))

    return bind(counted, rated)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row's whole text."""
    return docs.select("doc_id", measures(F.col("text"), F.col("lang")).alias("_m")).select("doc_id", "_m.*")


def _log_gamma(x: Column) -> Column:
    """Stirling's series at x + 10, carried back to x: exact to about 1e-13."""
    y = x + 10
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5))
    for k in range(10):
        series = series - F.log(x + k)
    return series


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), exact for k < n * p; 1 from there on.

    The last term comes from log-gammas; terms before it follow by their
    ratio until they can no longer count (12 standard deviations and 100).
    """
    k, n = k.cast("double"), n.cast("double")
    last = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    steps = F.least(k, F.ceil(12 * F.sqrt(n * (p * (1 - p)))) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))

    def add(state: Column, j: Column) -> Column:
        ratio = (k - j) / (n - k + j + 1) * ((1 - p) / p)
        return F.struct((state["term"] * ratio).alias("term"), (state["sum"] + state["term"]).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(0), steps), start, add)["sum"]
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(last) * total)


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """stratum and, by rule, the cutoff of the strictest admitted step; strata without one are absent."""
    agreed = labels.groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("_most")).where("good = 1 AND _most = 1").select("doc_id")
    held = measured.join(agreed, "doc_id", "left_semi")
    dropped = [F.count_if(functools.reduce(Column.__or__, [F.col(rule) > cut for rule, cut in step.items()])).alias(f"k{i}") for i, step in enumerate(STEPS)]
    counts = checkpointed(held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *dropped))
    level = alpha / max(1, counts.count())
    tests = [F.struct(F.lit(i).alias("step"), F.col(f"k{i}").alias("k")) for i in range(len(STEPS))]
    admitted = counts.select("stratum", "n", F.inline(F.array(*tests))).where(binomial_tail(F.col("k"), F.col("n"), risk) <= level)
    ends = admitted.groupBy("stratum").agg(F.max("step").alias("step"))
    return ends.select("stratum", *[F.get(F.array(*[F.lit(step[rule]) for step in STEPS]), F.col("step")).alias(f"max_{rule}") for rule in GRIDS])


def _failed(rate) -> Column:
    """The rules that a row fails, joined by commas; ``rate`` gives a rule's column."""
    return F.concat_ws(",", *[F.when(rate(rule) > F.col(f"max_{rule}"), rule) for rule in GRIDS])


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): measures, the rules failed, base_failed and kept.

    ``labels`` (doc_id, quality) are the holdouts. The measures are checkpointed:
    narrow rows, read once for the cutoffs and once for the verdicts.
    """
    measured = checkpointed(measure(docs))
    limits = F.broadcast(cutoffs(measured, labels.select("doc_id", "quality"), risk, alpha))  # one row a stratum
    rows = measured.join(limits, "stratum", "left").withColumn("failed_rules", _failed(F.col))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "failed_rules")


def keep(docs: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Texts are measured twice, for the cutoffs and to filter, so that they need not be shuffled.
    """
    limits = cutoffs(measure(docs), labels.select("doc_id", "quality"), risk, alpha).withColumnRenamed("stratum", "_stratum")
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), measures(F.col("text"), F.col("lang")).alias("_m"))
    rows = judged.where(~F.col("_m.base_failed")).join(F.broadcast(limits), F.col("_m.stratum") == F.col("_stratum"), "left")
    return rows.where(_failed(lambda rule: F.col(f"_m.{rule}")) == "").select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _oracle() -> str:
    pick = [f"({k}, '{rule}', CAST({cut} AS DOUBLE))" for k, step in enumerate(STEPS) for rule, cut in step.items()]
    rates = ", ".join(GRIDS)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         CASE WHEN regexp_full_match(lang, '[a-z]{{2,3}}') THEN lang ELSE 'other' END AS stratum
  FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \\t\\n\\x0B\\x0C\\r]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\x0C\\r]')) AS ls FROM d),
g AS (SELECT rid, i, list_extract(ws, i) || ' ' || list_extract(ws, i + 1) || ' ' || list_extract(ws, i + 2) AS gram
      FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c >= 2),
cover AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS off(o) GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[ \\t\\n\\x0B\\x0C\\r]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS upper_chars,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cover USING (rid)),
f AS (
  SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_rate, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_rate,
    coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_rate, coalesce(upper_chars / nullif(word_chars, 0), 0) AS upper_rate,
    coalesce(word_chars / nullif(n_words, 0), 0) AS chars_per_word,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m),
long AS (UNPIVOT (SELECT rid, doc_id, stratum, {rates} FROM f) ON {rates} INTO NAME rule VALUE rate),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
grid(step, rule, cut) AS (VALUES {", ".join(pick)}),
each AS (SELECT rid, stratum, step, bool_or(rate > cut) AS dropped FROM long JOIN grid USING (rule) WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY ALL),
k AS (SELECT stratum, step, count(*) AS n, count(*) FILTER (dropped) AS k FROM each GROUP BY ALL),
p AS (SELECT *, (SELECT count(DISTINCT stratum) FROM k) AS strata,
        CASE WHEN k >= n * {RISK} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
          exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) END AS tail FROM k),
ends AS (SELECT stratum, max(step) AS step FROM p WHERE tail <= {ALPHA} / strata GROUP BY ALL),
cuts AS (SELECT stratum, rule, cut FROM ends JOIN grid USING (step)),
bad AS (SELECT rid, list(rule) AS failed FROM long JOIN cuts USING (stratum, rule) WHERE rate > cut GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed IS NULL AS kept, stratum,
  coalesce(array_to_string(list_filter([{", ".join(f"'{r}'" for r in GRIDS)}], lambda x: list_contains(failed, x)), ','), '') AS failed_rules
FROM f LEFT JOIN bad USING (rid)"""


ORACLE = _oracle()
