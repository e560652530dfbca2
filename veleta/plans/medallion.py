"""Bronze to silver to gold jobs (MED1-4)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from veleta.operators.dedup import distinct_rows
from veleta.operators.rollup import day_rollup, month_rollup, station_daily_mean
from veleta.operators.shaping import keep_any_not_null
from veleta.sinks.tables import write_table
from veleta.sources.tables import scan

# Columns of the wind observation tables.
MEASURES = ["dd_valor", "ff_valor", "VRB_Valor"]
FACT_COLUMNS = ["time", *MEASURES, "CodigoNacional"]
STATION_COLUMNS = ["CodigoNacional", "latitud", "longitud", "nombreEstacion"]


def wind_fact(bronze: DataFrame) -> DataFrame:
    return keep_any_not_null(bronze.select(*FACT_COLUMNS), MEASURES)


def station_dim(bronze: DataFrame) -> DataFrame:
    return distinct_rows(bronze, STATION_COLUMNS)


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, fmt: str = "parquet") -> tuple[str, str]:
    """Observation fact and station dimension out of one bronze table (MED1)."""
    source = scan(spark, bronze)
    dim = write_table(station_dim(source), f"{silver}.dim_estaciones", fmt)
    fact = write_table(wind_fact(source), f"{silver}.ft_vientos", fmt)
    return fact, dim


def silver_rollups(spark: SparkSession, silver: str, fmt: str = "parquet", digits: int = 2) -> tuple[str, str]:
    """Day table over all stations, month table per station (MED2)."""
    fact = scan(spark, f"{silver}.ft_vientos")
    day = write_table(day_rollup(fact), f"{silver}.ft_viento_anno_mes_dia", fmt)
    month = write_table(month_rollup(fact, digits), f"{silver}.ft_viento_anno_mes", fmt)
    return day, month


def silver_to_gold(spark: SparkSession, silver: str, gold: str, fmt: str = "parquet", digits: int = 2) -> str:
    """Daily mean per station as training data (MED3)."""
    daily = station_daily_mean(scan(spark, f"{silver}.ft_vientos"), digits)
    return write_table(daily, f"{gold}.ml_train_data_viento_promedio", fmt)


def run_chain(steps: Sequence[Callable[[], object]]) -> list[object]:
    """Run steps in turn; a step runs only when the one before it succeeded (MED4)."""
    return [step() for step in steps]
