"""Augmented Dickey-Fuller test of every series (TSA2), after Said and Dickey."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veleta.operators.moments import per_group, product_sums, regress
from veleta.operators.series import _known, with_positions
from veleta.session import stabilise

# MacKinnon (1994) p-value surface, constant only, below and above tau = -1.61.
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
P_SWITCH, P_LOWEST, P_HIGHEST = -1.61, -18.83, 2.74
# MacKinnon (2010) critical values, constant only, as polynomials in 1/n.
CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def unit_root_p(tau: float) -> float:
    if tau <= P_LOWEST:
        return 0.0
    if tau >= P_HIGHEST:
        return 1.0
    surface = P_SMALL if tau <= P_SWITCH else P_LARGE
    z = sum(c * tau**i for i, c in enumerate(surface))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def critical_values(n: int) -> dict[str, float]:
    return {level: sum(c / n**i for i, c in enumerate(cs)) for level, cs in CRITICAL.items()}


def _by_criterion(key_type: str):
    """Number of lags with the least information criterion, all fitted on the same days."""

    def rows_of(group, products):
        n, scores = products[2, 2], []
        for lags in range(int(group["most"]) + 1):
            fit = regress(products, 0, list(range(1, 3 + lags)))
            scores.append(math.inf if fit is None else n * math.log(fit[2] / n) + 2 * (2 + lags))
        return [(group["key"], int(np.argmin(scores)))] if scores and min(scores) < math.inf else []

    return f"key {key_type}, lags int", rows_of


def unit_root_test(series: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Statistic, p-value, lags, critical values and verdict of every series (TSA2).

    Up to 12 (n / 100)^(1/4) lags are tried on the days that all of them can use, in one pass; the
    chosen number is then fitted on all of its days, in a second one. Series that are constant or
    too short have no statistic.
    """
    key_type = series.schema["key"].dataType.simpleString()
    placed = stabilise(with_positions(_known(series).select("key", "t", "y")), "series")
    most = F.least(F.ceil(12 * F.pow(F.col("n") / 100, F.lit(0.25))), F.floor(F.col("n") / 2) - 2).cast("int")
    about = placed.groupBy("key").agg(F.first("n").alias("n")).withColumn("most", most)
    deepest = max(0, about.agg(F.max("most")).first()[0] or 0)

    w = Window.partitionBy("key").orderBy("t")
    level = F.lag("y").over(w)
    moved = placed.withColumns({"level": level, "move": F.col("y") - level})
    lags = [F.coalesce(F.lag("move", k).over(w), F.lit(0.0)) for k in range(1, deepest + 1)]
    x = F.array(F.col("move"), F.col("level"), F.lit(1.0), *lags)
    vectors = stabilise(moved.withColumn("x", x).where("pos > 1").select("key", "pos", "x"), "vectors")

    tried = vectors.join(about.where("most >= 0"), "key").where("pos > most + 1")
    schema, rows_of = _by_criterion(key_type)
    sums = product_sums(tried, ["key", "most"])
    chosen = stabilise(per_group(sums, schema, rows_of), "lags")

    def tested(group, products):
        lags_, n = int(group["lags"]), products[2, 2]
        fit, free = regress(products, 0, list(range(1, 3 + lags_))), n - 2 - lags_
        if fit is None or free <= 0:
            return []
        tau = float(fit[0][0] / math.sqrt(fit[2] / free * fit[1][0]))
        p, crit = unit_root_p(tau), critical_values(int(n))
        return [(group["key"], tau, p, lags_, int(n), crit["1%"], crit["5%"], crit["10%"], bool(p <= alpha))]

    final = product_sums(vectors.join(chosen, "key").where("pos > lags + 1"), ["key", "lags"])
    found = per_group(
        final,
        f"key {key_type}, statistic double, p_value double, lags bigint, nobs bigint, crit_1 double, crit_5 double, crit_10 double, is_stationary boolean",
        tested,
    )
    return about.select("key", "n").join(found, "key", "left")
