"""Tables that readers never see half written (SNK1-2)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veleta.functions.naming import catalog_name
from veleta.sinks.tables import assert_same

# Property of a table that names its version.
_VERSION = "published.version"


def _root(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    place = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").where("info_name = 'Location'").first()[1]
    return f"{place.rstrip('/')}/{name}.versions"


def publish(df: DataFrame, name: str, check: Callable[[DataFrame], None] | None = None, fmt: str = "parquet") -> str:
    """Write a new version of a table and let the name point to it; returns the version's folder.

    The version goes to a folder of its own, is read back and compared with `df` and given to
    `check`, which may raise. Only then is the name moved: one change in the catalog, so a reader
    sees the old rows or the new ones. When anything fails before, the old version stays. Columns
    may differ from those of the version before. Old folders stay where they are, for `roll_back`
    and for readers that are still at work.
    """
    spark, table = df.sparkSession, catalog_name(name)
    folder = f"{_root(spark, table)}/v-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(folder)
    written = spark.read.format(fmt).load(folder)
    assert_same(df, written, name)
    if check is not None:
        check(written)
    _point(spark, table, folder, fmt)
    return folder


def _point(spark: SparkSession, table: str, folder: str, fmt: str) -> None:
    # A view is replaced in one step, whatever its columns; a table's columns could only be
    # changed by dropping it first.
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_VERSION}' = '{folder}') AS SELECT * FROM {fmt}.`{folder}`")


def version_of(spark: SparkSession, name: str) -> str:
    """Folder of the version that the name points to."""
    return spark.sql(f"SHOW TBLPROPERTIES {catalog_name(name)} ('{_VERSION}')").first()["value"]


def roll_back(spark: SparkSession, name: str, folder: str, fmt: str = "parquet") -> None:
    """Let the name point to an earlier version again."""
    _point(spark, catalog_name(name), folder, fmt)
