"""Factor columns as 0/1 columns (treatment contrasts).

A factor of L levels becomes L - 1 columns, one for each level but the first
in order, as a model formula expands it: the first level is the baseline, all
zeros. Levels are those of the rows fitted on. A level that was not among them,
and a null, is coded like the baseline and told apart by nothing, so a model
scores such rows as baseline rows; ``unseen="error"`` raises instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most levels of a factor: a column each. More is an error, not a cut.
MAX_LEVELS = 1000


def contrast_name(column: str, level: str) -> str:
    return f"{column}_{level}"


@dataclass
class Contrasts:
    """Levels of each factor in order; the first is the baseline."""
    levels: dict[str, list[str]]

    def columns(self, columns: Sequence[str]) -> list[str]:
        """Names after the expansion."""
        return [n for c in columns for n in ([contrast_name(c, x) for x in self.levels[c][1:]] if c in self.levels else [c])]

    def transform(self, df: DataFrame, unseen: str = "baseline") -> DataFrame:
        """Each factor's columns in its place."""
        if unseen not in ("baseline", "error"):
            raise ValueError("unseen is baseline or error")
        out = []
        for c in df.columns:
            if c not in self.levels:
                out.append(F.col(c))
                continue
            value = F.col(c)
            if unseen == "error":
                value = F.when(F.col(c).isin(self.levels[c]), F.col(c)).otherwise(
                    F.raise_error(F.concat(F.lit(f"level of {c} was not fitted: "), F.coalesce(F.col(c), F.lit("null")))))
            out += [F.coalesce((value == x).cast("double"), F.lit(0.0)).alias(contrast_name(c, x)) for x in self.levels[c][1:]]
        return df.select(*out)


def fit_contrasts(df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = MAX_LEVELS) -> Contrasts:
    """Levels of ``columns`` (default: all text columns), from one
    aggregate. Nulls are no level."""
    columns = [c for c, t in df.dtypes if t == "string"] if columns is None else list(columns)
    if not columns:
        return Contrasts({})
    # Counted before they are gathered, so that what reaches a task or the
    # driver is bounded.
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    many = [c for c in columns if counts[c] > 1.2 * max_levels]
    if not many:
        sets = df.agg(*[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in columns]).first()
        many = [c for c in columns if len(sets[c]) > max_levels]
    if many:
        raise ValueError(f"more than {max_levels} levels: {', '.join(many)}; encode such a column by its outcome rate instead")
    return Contrasts({c: list(sets[c]) for c in columns})
