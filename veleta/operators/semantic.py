"""Semantic layer: named measures, relationships, cross-filters (SEM1-3, JON1-2, AGG9-12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """A named aggregate of one fact column; a weighted mean also names its weight column."""

    fn: str
    column: str
    weight: str | None = None

    def partial(self, name: str) -> list[Column]:
        c = F.col(self.column)
        if self.fn == "avg":
            return [F.sum(c).alias(f"{name}__s"), F.count(c).alias(f"{name}__n")]
        if self.fn == "weighted_avg":
            w = F.when(c.isNotNull(), F.col(self.weight))
            return [F.sum(c * w).alias(f"{name}__s"), F.sum(w).alias(f"{name}__n")]
        return [{"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.fn](c).alias(f"{name}__p")]

    def final(self, name: str) -> Column:
        if self.fn in ("avg", "weighted_avg"):
            return F.try_divide(F.sum(f"{name}__s"), F.sum(f"{name}__n")).alias(name)
        combine = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.fn]
        return combine(f"{name}__p").alias(name)


@dataclass(frozen=True)
class Relationship:
    """Many fact rows to one row of dimension `dim`, by equal keys."""

    fact_key: str
    dim: str
    dim_key: str


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that a dimension holds more than once."""
    return dim.groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def relate(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, check: bool = True) -> DataFrame:
    """Fact rows with the columns of their dimension row; unmatched facts keep NULLs (JON1).

    No broadcast is forced: Spark broadcasts the dimension when its measured size allows it
    and otherwise joins by key with skewed keys split.
    """
    if check and not repeated_keys(dim, dim_key).isEmpty():
        raise ValueError(f"{dim_key} is not unique in the dimension; see latest_per_key")
    if fact_key == dim_key:
        return fact.join(dim, fact_key, "left")
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left")


def cross_filter(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, selection: Column) -> DataFrame:
    """Fact rows related to a selected dimension row (JON2)."""
    chosen = dim.where(selection).select(F.col(dim_key).alias(fact_key))
    return fact.join(chosen, fact_key, "left_semi").select(*fact.columns)


@dataclass(frozen=True)
class SemanticModel:
    """A fact table with dimensions, named measures and default summaries.

    `summarize_by` gives a column its default: "sum" adds it up, "none" makes it a category.
    """

    fact: DataFrame
    dims: Mapping[str, DataFrame] = field(default_factory=dict)
    relationships: Sequence[Relationship] = ()
    measures: Mapping[str, Measure] = field(default_factory=dict)
    summarize_by: Mapping[str, str] = field(default_factory=dict)

    def _relationship(self, dim: str) -> Relationship:
        found = [r for r in self.relationships if r.dim == dim]
        if len(found) != 1:
            raise ValueError(f"{len(found)} relationships lead to {dim!r}")
        return found[0]

    def _measure(self, name: str) -> Measure:
        if name in self.measures:
            return self.measures[name]
        if self.summarize_by.get(name) == "sum":
            return Measure("sum", name)
        raise ValueError(f"{name!r} is neither a measure nor a column that is summed by default")

    def query(
        self,
        dims: Sequence[str],
        measures: Sequence[str],
        order: Sequence[str] = (),
        where: Column | None = None,
        selections: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Measures by categories (SEM1). "dim.column" reads a column of a related dimension.

        The fact is first aggregated to the relationship keys and its own categories, and only
        those groups meet the dimensions. The join therefore sees each key once per category,
        however many fact rows the key has. A dimension that repeats a key gives the least of its
        rows, so no fact counts twice. `selections` filters facts through a dimension.
        """
        fact = self.fact if where is None else self.fact.where(where)
        for dim, selection in (selections or {}).items():
            r = self._relationship(dim)
            fact = cross_filter(fact, self.dims[dim], r.fact_key, r.dim_key, selection)

        foreign = dict.fromkeys(d.split(".")[0] for d in dims if "." in d)
        links = {dim: self._relationship(dim) for dim in foreign}
        own = [d for d in dims if "." not in d]
        used = {m: self._measure(m) for m in measures}

        link_keys = {dim: f"__key_{i}" for i, dim in enumerate(links)}
        group = [F.col(c) for c in own] + [F.col(links[d].fact_key).alias(k) for d, k in link_keys.items()]
        partial = [p for name, m in used.items() for p in m.partial(name)]
        grouped = fact.groupBy(*group).agg(*partial)

        labels = {d: d.split(".")[1] if "." in d else d for d in dims}
        for dim, key in link_keys.items():
            wanted = [d.split(".")[1] for d in dims if d.startswith(f"{dim}.")]
            side = self.dims[dim].select(F.col(links[dim].dim_key).alias(key), F.struct(*wanted).alias("__row"))
            side = side.groupBy(key).agg(F.min("__row").alias("__row")).select(key, "__row.*")
            grouped = grouped.join(side, key, "left")
        out = grouped.groupBy(*[labels[d] for d in dims]).agg(*[m.final(n) for n, m in used.items()])
        return out.orderBy(*[labels.get(o, o) for o in order]) if order else out

    def default_summary(self, dims: Sequence[str]) -> DataFrame:
        """Every column that is summed by default, by the given categories (AGG10-11)."""
        sums = [c for c, how in self.summarize_by.items() if how == "sum" and c not in dims]
        return self.query(dims, sums)
