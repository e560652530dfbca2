"""Rule scores and threshold labels (SCR1-6, FN-CASE, FN-EMOJI)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[Column, int]


def first_match(rules: Sequence[Rule], otherwise: object) -> Column:
    """Points of the first rule that holds. A NULL condition does not hold."""
    branches = F
    for condition, points in rules:
        branches = branches.when(condition, F.lit(points))
    return branches.otherwise(F.lit(otherwise))


def band_rules(value: Column, bands: Sequence[tuple[float, int]], floor: float | None = None) -> list[Rule]:
    """Rules for "from the floor up to this limit, these points", limits included."""
    enough = F.lit(True) if floor is None else value >= floor
    return [(enough & (value <= limit), points) for limit, points in bands]


def rule_score(
    df: DataFrame, rules: Mapping[str, Sequence[Rule]], otherwise: Mapping[str, int] | int = 0, total: str | None = None
) -> DataFrame:
    """Append one score column per entry, and their sum as `total` when it is named."""
    fallback = otherwise if isinstance(otherwise, Mapping) else dict.fromkeys(rules, otherwise)
    scored = df.withColumns({name: first_match(r, fallback.get(name, 0)) for name, r in rules.items()})
    if total is None:
        return scored
    whole = sum((F.col(name) for name in rules), start=F.lit(0))
    return scored.withColumn(total, whole)


def label_by_threshold(
    df: DataFrame, score: str, labels: Sequence[tuple[float, str]], otherwise: str, out: str
) -> DataFrame:
    """Append the label of the first minimum that the score reaches."""
    return df.withColumn(out, first_match([(F.col(score) >= least, text) for least, text in labels], otherwise))
