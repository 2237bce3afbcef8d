"""Quality rules with risk-controlled thresholds.

Every rule rejects a document whose measure lies above a cutoff. The rules
tighten together along fixed levels, so rejections are nested from level
to level. In each stratum (a language) the labelled good documents of the
holdout tell how many any rule would reject by mistake at a level. A level
is accepted when the exact binomial (Clopper-Pearson) bound on the true
false-rejection rate lies below ``alpha``. Levels are tested from the
loosest on until the first failure, a fixed sequence that needs no further
correction; over the strata the error probability is split (Bonferroni).
So with probability at least ``1 - delta`` no accepted level of any
stratum rejects more than ``alpha`` of its good documents. Among the
accepted levels, all of which hold at once, the loosest one is used that
rejects nearly as many labelled bad documents as the strictest. A stratum
with too few labels for any proof gets no cutoffs: its documents only face
the base rule.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD_BREAKS, small_batches, written

ALPHA, DELTA = 0.02, 0.05
#: Share of the strictest level's labelled bad rejections that is enough.
NEARLY = 0.99
MIN_WORDS = 50

# The symbols that are counted, and letters by case.
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))

#: Rule name -> cutoff at each level, loosest first.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.75, 0.6, 0.45, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05),
    "duplicate_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeated_words": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "capitals": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "shouting": (2.0, 1.5, 1.0, 0.75, 0.6, 0.45, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05),
}
LEVELS = 12
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(text: str | None) -> tuple:
    """The five counts and then the measure of each rule."""
    if not text:
        return (0,) * len(_COUNTS) + (0.0,) * len(RULES)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, c in Counter(windows).items() if c > 1}
        inside = np.zeros(n, dtype=bool)
        at = np.flatnonzero([w in often for w in windows])
        for k in range(3):
            inside[at + k] = True
        repeated = int(inside.sum())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    doubled = len(lines) - len(set(lines))
    count = lambda chars: len(data) - len(data.translate(None, chars))
    symbols, letters = count(SYMBOLS), count(LETTERS)
    return (n, len(text) - sum(text.count(c) for c in WORD_BREAKS), symbols, doubled, repeated,
            symbols / max(n, 1), doubled / max(len(lines), 1), repeated / max(n, 1),
            count(UPPER) / max(letters, 1), data.count(b"!") / max(n, 1))


def base_failed(m: tuple) -> bool:
    return m[0] < MIN_WORDS or 100 * m[4] > 50 * m[0]


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) for success probability p, exactly summed."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    i = np.arange(k + 1)
    log_choose = np.concatenate(([0.0], np.cumsum(np.log(n - i[:-1]) - np.log(i[:-1] + 1.0))))
    terms = log_choose + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(min(1.0, math.exp(top) * np.exp(terms - top).sum()))


def pick_level(good: list[int], n_good: int, bad: list[int], alpha: float, error: float) -> int | None:
    """Level to use, given how many of ``n_good`` good documents and how
    many bad ones each level rejects."""
    accepted = 0
    while accepted < len(good) and good[accepted] <= alpha * n_good and \
            binomial_tail(good[accepted], n_good, alpha) <= error:
        accepted += 1
    if not accepted:
        return None
    return next(i for i in range(accepted) if bad[i] >= NEARLY * bad[accepted - 1])


_MEASURED = "struct<" + ",".join([f"{c}:bigint" for c in _COUNTS] + [f"{r}:double" for r in RULES]) + ">"


def measured(text: Column) -> Column:
    @F.pandas_udf(_MEASURED)
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measures(t) for t in texts], columns=[*_COUNTS, *RULES])
    return counted(text)


def stratum(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def measure_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, stratum`` and all measures: a narrow table, written once."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", stratum(docs).alias("stratum"), measured(F.col("text")).alias("m"))
    return written(rows.select("doc_id", "stratum", "m.*"), "quality-measures")


def calibrate(narrow: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[str, int]:
    """Level by stratum, from all labelled documents that pass the base
    rule. A document labelled more than once is good only if every label
    says so; null labels are ignored."""
    marked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    held = narrow.filter(~_base(narrow)).join(marked, "doc_id")
    rejects = [reduce(or_, [F.col(r) > cs[i] for r, cs in RULES.items()]) for i in range(LEVELS)]
    of = lambda q, i: F.count_if((F.col("quality") == q) & rejects[i]).alias(f"q{q}_{i}")
    # One row comes back for each stratum (language) with at least this many
    # good labels; below it no proof is possible.
    least = math.ceil(math.log(delta) / math.log1p(-alpha))
    table = held.groupBy("stratum").agg(F.count_if(F.col("quality") == 1).alias("n"),
                                        *[of(q, i) for q in (0, 1) for i in range(LEVELS)]).filter(F.col("n") >= least).collect()
    picked = {row["stratum"]: pick_level([row[f"q1_{i}"] for i in range(LEVELS)], row["n"],
                                         [row[f"q0_{i}"] for i in range(LEVELS)], alpha, delta / len(table)) for row in table}
    return {s: level for s, level in picked.items() if level is not None}


def _base(df: DataFrame) -> Column:
    return (df["n_words"] < MIN_WORDS) | (100 * df["n_repeat_words"] > 50 * df["n_words"])


def _failed_rules(levels: dict[str, int]) -> Column:
    """Names of the rules that a measured row fails, as an array."""
    if not levels:
        return F.array().cast("array<string>")
    table = lambda cutoffs: F.create_map(*[F.lit(x) for s, i in levels.items() for x in (s, cutoffs[i])])
    return F.array_compact(F.array(*[F.when(F.col(rule) > table(cutoffs)[F.col("stratum")], F.lit(rule))
                                     for rule, cutoffs in RULES.items()]))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, failed_rules`` per row of ``docs``.

    Null, empty and wordless texts have zero counts and fail the base rule.
    Repeated rows are judged alike; a measure equal to a cutoff passes. A
    null or missing language is a stratum of its own. Without labels only
    the base rule rejects. Extra columns are ignored; an empty table gives
    an empty result."""
    narrow = measure_documents(docs)
    levels = calibrate(narrow, labels, alpha, delta)
    rows = narrow.withColumn("base_failed", _base(narrow)).withColumn("failed_rules", _failed_rules(levels))
    return rows.select("doc_id", *_COUNTS, "base_failed",
                       (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
                       F.array_join("failed_rules", ",").alias("failed_rules"))


def keep(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep. Texts are
    measured a second time instead of being shuffled to the verdicts."""
    levels = calibrate(measure_documents(docs), labels, alpha, delta)

    def verdict(s: str, m: tuple) -> bool:
        level = levels.get(s)
        return not base_failed(m) and (level is None or all(
            m[len(_COUNTS) + k] <= cutoffs[level] for k, cutoffs in enumerate(RULES.values())))

    @F.pandas_udf("boolean")
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, strata in batches:
            yield pd.Series([verdict(s, measures(t)) for t, s in zip(texts, strata)], dtype=bool)

    return docs.filter(kept(F.col("text"), stratum(docs)))
