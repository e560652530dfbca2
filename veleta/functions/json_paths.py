"""Typed columns out of JSON text by path (FN-JSON)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.functions.casts import CASTS


def _steps(path: str) -> list[str]:
    return [s for s in path.removeprefix("$").split(".") if s]


def _schema(paths: list[list[str]]) -> T.StructType:
    """Smallest struct that holds every path; leaves stay text until they are cast."""
    heads = dict.fromkeys(p[0] for p in paths)
    fields = []
    for head in heads:
        rest = [p[1:] for p in paths if p[0] == head and len(p) > 1]
        fields.append(T.StructField(head, _schema(rest) if rest else T.StringType()))
    return T.StructType(fields)


def shred(df: DataFrame, fields: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """Append one typed column per entry `out: (source column, "$.a.b", type)`.

    Every source column is parsed once, whatever the number of paths read from it, and only
    the requested paths are kept. Path "$" takes the column itself. Malformed documents,
    absent paths and unreadable values give NULL. VARIANT sources are read by path directly.
    """
    by_source: dict[str, list[list[str]]] = {}
    for source, path, _ in fields.values():
        by_source.setdefault(source, []).append(_steps(path))

    staged, parsed = {}, {}
    for i, (source, paths) in enumerate(by_source.items()):
        nested = [p for p in paths if p]
        if nested and isinstance(df.schema[source].dataType, T.StringType):
            parsed[source] = f"__parsed_{i}"
            staged[parsed[source]] = F.from_json(F.col(source), _schema(nested))

    def leaf(source: str, path: str, kind: str) -> Column:
        steps = _steps(path)
        if not steps:
            return CASTS[kind](F.col(source))
        if source in parsed:
            value = F.col(parsed[source])
            for step in steps:
                value = value.getField(step)
        else:
            value = F.try_variant_get(F.col(source), path, "string")
        return CASTS[kind](value)

    wide = df.withColumns(staged) if staged else df
    out = {name: leaf(*spec) for name, spec in fields.items()}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return wide.select(*kept, *[c.alias(name) for name, c in out.items()])
