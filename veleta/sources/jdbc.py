"""Relational table scan (SRC5, PRJ2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    schema: str,
    item: str,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options. With `split_on` the table is read as `partitions` ranges side by side."""
    options = {"url": url, "dbtable": f"{schema}.{item}", "fetchsize": str(fetch_size), **extra}
    if split_on is not None:
        if bounds is None or partitions < 2:
            raise ValueError("a split read needs bounds and at least two partitions")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, schema: str, item: str, cols: Sequence[str] | None = None, **options
) -> DataFrame:
    """Scan `schema.item`; the column list reaches the database's own SELECT."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, schema, item, **options)).load()
    return df.select(*cols) if cols else df
