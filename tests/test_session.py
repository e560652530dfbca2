import subprocess
import sys
from pathlib import Path

from veleta.session import run_dir, ship_package, stabilise

ROOT = Path(__file__).resolve().parents[1]

ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from veleta.operators.forecasting import arima_search
from veleta.session import local_session
spark = local_session(2)
daily = spark.range(60).selectExpr("'a' AS key", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS t", "sin(id) + id % 3 AS y")
print("fits", arima_search(daily, [(0, 0, 0), (1, 0, 0)]).where("aic IS NOT NULL").count())
"""


def test_package_is_shipped_once(spark):
    ship_package(spark)
    ship_package(spark)
    assert sum(f.endswith("/veleta.zip") for f in spark.sparkContext.listFiles) == 1


def test_workers_find_the_package_from_any_folder(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", ELSEWHERE.format(root=str(ROOT))], cwd=tmp_path, capture_output=True, text=True, timeout=180
    )
    assert "fits 2" in done.stdout, done.stderr[-2000:]


def test_stored_stage_keeps_rows_and_schema(spark):
    df = spark.sql("SELECT 1 AS `a b`, CAST(NULL AS DATE) AS d, array('x') AS l")
    back = stabilise(df)
    assert back.collect() == df.collect() and back.dtypes == df.dtypes
    assert run_dir(spark, "x") != run_dir(spark, "x")
