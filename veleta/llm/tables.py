"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads, as doc_id and text; all others stay behind."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow with this package on the Python workers' path."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)
