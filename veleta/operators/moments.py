"""Least squares of every group at once, out of sums of products.

Rows carry a vector; each task adds up the products of its rows per group, Spark adds up the
tasks, and a group is left with one small matrix. Every regression of one component on others is a
few lines of algebra on that matrix, so many models cost one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.session import ship_package

# Below this share of the target's own sum of squares nothing is left to explain.
_NOTHING = 1e-13


def _partial(groups: Sequence[str], vector: str):
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, own in pdf.groupby(list(groups), dropna=False, sort=False):
                x = np.stack(own[vector].to_numpy())
                out = own[list(groups)].head(1)
                yield out.assign(products=[(x.T @ x).ravel()])

    return sums


def product_sums(rows: DataFrame, groups: Sequence[str], vector: str = "x") -> DataFrame:
    """groups and `products`, the sums over rows of x_i * x_j, row by row of the matrix.

    Vectors have no NULL and are of one length. A hot group sends one matrix per batch of rows.
    """
    ship_package(rows.sparkSession)
    fields = ", ".join(f"`{g}` {rows.schema[g].dataType.simpleString()}" for g in groups)
    parts = rows.select(*groups, vector).mapInPandas(_partial(groups, vector), f"{fields}, products array<double>")
    each = parts.select(*groups, F.posexplode("products").alias("at", "v")).groupBy(*groups, "at").agg(F.sum("v").alias("v"))
    listed = F.sort_array(F.collect_list(F.struct("at", "v")))  # as many as the matrix has
    return each.groupBy(*groups).agg(F.transform(listed, lambda s: s["v"]).alias("products"))


def regress(products: np.ndarray, target: int, on: Sequence[int]) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Coefficients, the diagonal of the inverse and the sum of squares left over; None where that has no answer."""
    total = products[target, target]
    if not on:
        return (np.zeros(0), np.zeros(0), float(total)) if total > 0 else None
    a, b = products[np.ix_(on, on)], products[on, target]
    size = np.sqrt(np.diag(a))
    if not np.all(np.isfinite(a)) or np.any(size <= 0):
        return None
    scaled = a / np.outer(size, size)
    if np.linalg.matrix_rank(scaled, tol=1e-12) < len(on):
        return None
    inverse = np.linalg.inv(scaled) / np.outer(size, size)
    beta = np.linalg.solve(scaled, b / size) / size
    left = float(total - b @ beta)
    return (beta, np.diag(inverse), left) if left > _NOTHING * total else None


def per_group(sums: DataFrame, schema: str, rows_of: Callable[[pd.Series, np.ndarray], list[tuple]]) -> DataFrame:
    """Rows that a small function makes of each group and its matrix."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for _, group in pdf.iterrows():
                flat = np.asarray(group["products"], float)
                width = int(round(len(flat) ** 0.5))
                out += rows_of(group, flat.reshape(width, width))
            yield pd.DataFrame(out, columns=names).astype(object) if out else pd.DataFrame(columns=names)

    names = [c.strip().split(" ")[0].strip("`") for c in schema.split(", ")]
    ship_package(sums.sparkSession)
    return sums.mapInPandas(made, schema)
