"""Table writers and DDL (SNK1-4, SNK7-9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.functions.naming import catalog_name, clean_identifier


def open_lakehouse(spark: SparkSession, name: str, schema: str = "dbo", location: str | None = None) -> str:
    """Make sure the database behind `name.schema` exists; returns `name.schema`."""
    database = catalog_name(f"{name}.{schema}.t").split(".")[0]
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    return f"{name}.{schema}"


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    replace_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> str:
    """Write a managed table. Rows are not sorted first: order in a table has no meaning."""
    table = catalog_name(name)
    writer = df.write.format(fmt).mode(mode)
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return table


def save_path(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return path


def create_table(spark: SparkSession, name: str, columns: Mapping[str, str], fmt: str = "parquet") -> str:
    """Create the table when it does not exist yet; `columns` is name to SQL type."""
    table = catalog_name(name)
    body = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING {fmt}")
    return table


def load_to_new_table(df: DataFrame, name: str, fmt: str = "parquet") -> str:
    """Land a query result; table and column names are cleaned so that any catalog takes them."""
    renamed = df.toDF(*[clean_identifier(c) for c in df.columns])
    return write_table(renamed, name, fmt)


def assert_written(df: DataFrame, name: str) -> None:
    """Read a table back and fail when columns or rows differ from `df`."""
    assert_same(df, df.sparkSession.read.table(catalog_name(name)), name)


def assert_same(df: DataFrame, stored: DataFrame, name: str) -> None:
    """Fail when columns or rows of two frames differ.

    Both sides are reduced to (row count, order-free hash sums) in one aggregate each, so
    the check moves a single row per side and costs no shuffle of the data.
    """
    if stored.dtypes != df.dtypes:
        raise AssertionError(f"schema of {name} differs: {stored.schema} / {df.schema}")

    def digest(frame: DataFrame):
        row = F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]).cast("decimal(38,0)")
        cross = F.hash(*[F.col(f"`{c}`") for c in frame.columns]).cast("decimal(38,0)")
        return frame.agg(F.count("*").alias("n"), F.sum(row).alias("h"), F.sum(cross).alias("g")).first()

    if digest(df) != digest(stored):
        raise AssertionError(f"rows of {name} differ from the written frame")
