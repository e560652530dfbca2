"""Tables with one row per key that are kept up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.operators.dedup import latest_per_key

# Partition column of the table, named so that it meets no column of a row.
PART = "upsert__part"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def upsert(rows: DataFrame, path: str, keys: Sequence[str], newest: str, part: Column, tiebreak: Sequence[str] = ()) -> None:
    """Merge rows into the table at `path`: per key the row with the greatest `newest` stays.

    `part` gives the partition of a row and must follow from its keys, such as the day of a time
    key. Only partitions that the rows touch are read and rewritten. Merging the same rows again
    changes nothing, and the order in which rows arrive does not matter, as long as `newest` and
    `tiebreak` tell the rows of a key apart.
    """
    fresh = rows.withColumn(PART, part)
    stored = _stored(rows.sparkSession, path)
    if stored is not None:
        touched = fresh.select(PART).distinct()
        fresh = fresh.unionByName(stored.join(touched, PART, "left_semi"))
    kept = latest_per_key(fresh, keys, newest, tiebreak)
    kept.repartition(PART, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)
