"""Calendar rollups (AGG1-3)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS: dict[str, Callable[[Column], Column]] = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "date": F.to_date,
}
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum, "count": F.count,
}


def calendar_rollup(
    df: DataFrame,
    ts: str,
    parts: Mapping[str, str],
    aggs: Mapping[str, tuple[str, str]],
    keys: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Group by calendar parts of `ts` (output name to part) and by `keys`.

    `aggs` maps an output name to (function, column). Means are rounded to `digits`; None
    leaves them as they are. Every aggregate combines on the map side, so neither a busy key
    nor a busy day concentrates rows.
    """
    group = [*keys, *[PARTS[part](F.col(ts)).alias(name) for name, part in parts.items()]]

    def build(fn: str, col: str) -> Column:
        value = AGGREGATES[fn](F.col(col))
        return F.round(value, digits) if fn == "avg" and digits is not None else value

    return df.groupBy(*group).agg(*[build(*spec).alias(name) for name, spec in aggs.items()])


def day_rollup(obs: DataFrame, year_name: str = "año") -> DataFrame:
    """All stations per day: greatest and least direction, mean speed unrounded (AGG1)."""
    return calendar_rollup(
        obs,
        "time",
        {year_name: "year", "mes": "month", "dia": "day"},
        {
            "dir_racha1": ("max", "dd_valor"),
            "dir_racha2": ("min", "dd_valor"),
            "vv_viento_promedio": ("avg", "ff_valor"),
        },
    )


def month_rollup(obs: DataFrame, digits: int | None = 2) -> DataFrame:
    """Station and month: greatest direction under both names, rounded mean speed (AGG2)."""
    rolled = calendar_rollup(
        obs,
        "time",
        {"anno": "year", "mes": "month"},
        {
            "Dir_racha1": ("max", "dd_valor"),
            "Dir_racha2": ("max", "dd_valor"),
            "vv_viento_promedio": ("avg", "ff_valor"),
        },
        keys=["CodigoNacional"],
        digits=digits,
    )
    return rolled.select("anno", "mes", "Dir_racha1", "Dir_racha2", "vv_viento_promedio", "CodigoNacional")


def station_daily_mean(obs: DataFrame, digits: int | None = 2) -> DataFrame:
    """Station and day: rounded mean speed with its calendar parts (AGG3).

    Grouping is on station and date; year, month and day follow from the date afterwards, so
    the shuffle carries one calendar column instead of four.
    """
    daily = calendar_rollup(
        obs, "time", {"fecha": "date"}, {"vviento_promedio": ("avg", "ff_valor")}, ["CodigoNacional"], digits
    )
    return daily.select(
        "CodigoNacional",
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        F.dayofmonth("fecha").alias("dia"),
        "fecha",
        "vviento_promedio",
    )
