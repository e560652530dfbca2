"""Connected components of links, for any operator that links rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow
from veleta.session import stabilise


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: every end but the least of its component, with that least end."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        # Hook the roots of both ends below the lesser one, then shorten all paths.
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def _contract(batches):
    for batch in batches:
        u, v = forest(*(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (least node of the component) for every node that has a link to another.

    Each batch of links is first reduced to stars. Then large-star and small-star steps alternate
    until every node hangs on one root; each round is written to the shared folder. A hub's
    neighbours are only ever aggregated to a minimum, never gathered. Links from a node to itself
    and with a NULL end are passed over; repeated ones count once; no links give no rows.
    """
    ends = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    edges = stabilise(in_arrow(ends, _contract, "u long, v long").distinct(), "links")
    while True:
        shape = edges.agg(F.count("*").alias("n"), F.countDistinct("u").alias("nodes")).first()
        inner = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
        if shape["n"] == shape["nodes"] and inner.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        both = edges.union(edges.select("v", "u"))
        least = stabilise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        keep = least.filter("m < u").select("u", F.col("m").alias("v"))
        wide = stabilise(large.union(keep).filter("u <> v").distinct(), "links")
        low = stabilise(wide.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = wide.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stabilise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
