"""Table scans by name, by SQL and by path (SRC1-3, SRC7-8)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from veleta.functions.naming import catalog_name


def scan(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by one-, two- or three-part name."""
    return spark.read.table(catalog_name(name))


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Spark SQL text; frames are named in the text as {name}."""
    return spark.sql(sql, **frames)


def load_path(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_any(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    if "/" in name_or_path:
        return load_path(spark, name_or_path, fmt)
    return scan(spark, name_or_path)


def as_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Give a table owned elsewhere a local name; the data stays where it is.

    A name that leads to another place already is led to the new one.
    """
    table = catalog_name(name)
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    if spark.catalog.tableExists(table):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name IN ('Location', 'Type')").collect()
        facts = {r["col_name"]: r["data_type"] for r in described}
        if facts.get("Type") != "EXTERNAL":
            raise ValueError(f"{table} is a table of its own")
        if _bare(facts.get("Location", "")) != _bare(path):
            spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}'")
    return spark.read.table(table)


def _bare(path: str) -> str:
    """A path without the scheme of local files."""
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def records_frame(spark: SparkSession, rows: Iterable, schema: StructType | str | None = None) -> DataFrame:
    """Small local records, scalars or a pandas frame as a DataFrame."""
    return spark.createDataFrame(rows, schema)
