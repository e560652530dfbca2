"""Sources, shaping, dedup, rollups, profiles."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import functions as F

from veleta.operators import dedup, ordering, profile, rollup, shaping
from veleta.operators.quantiles import exact_medians
from veleta.plans.medallion import MEASURES, STATION_COLUMNS, bronze_to_silver, run_chain, silver_rollups
from veleta.plans.medallion import silver_to_gold, station_dim, wind_fact
from veleta.session import run_dir
from veleta.sinks import assert_written, create_table, load_to_new_table, open_lakehouse, save_path, write_table
from veleta.sources import as_table, load_path, pages_to_records, query, scan
from workload.adapters import FACT_SQL, WIND_SQL, table, wind_obs
from workload.registry import registered

# --- scans and projections ---------------------------------------------------------------

@registered("SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem WHERE l_quantity >= 25")
def scan_project_filter(spark, sf_dir):
    return (
        load_path(spark, f"{sf_dir}/lineitem.parquet")
        .where("l_quantity >= 25")
        .select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    )


@registered("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def sql_text_scan(spark, sf_dir):
    return query(
        spark,
        "SELECT n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
        nation=table(spark, sf_dir, "nation"),
        region=table(spark, sf_dir, "region"),
    )


@registered("SELECT c_custkey, c_name, c_acctbal FROM customer")
def table_shortcut(spark, sf_dir):
    name = f"customer_{crc32(sf_dir.encode())}"
    return as_table(spark, name, f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")


@registered(
    "SELECT event_id, value, value * 2 AS twice, value * 2 + 1 AS more, 'v1' AS model, 7 AS version FROM events"
)
def derived_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    wide = shaping.derive(events, twice=F.col("value") * 2, more=F.col("twice") + 1)
    return shaping.with_constants(wide, model="v1", version=7)


@registered("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderdate, o_totalprice FROM orders")
def key_and_time_casts(spark, sf_dir):
    """Double key to bigint, text to timestamp, time column first."""
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("double").alias("o_orderkey"),
        "o_totalprice",
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
    )
    return shaping.time_first(text.withColumn("o_orderkey", F.col("o_orderkey").try_cast("bigint")), "o_orderdate")


@registered('SELECT l_orderkey AS l_order_key, l_quantity AS qty_units_, l_tax AS tax FROM lineitem')
def rename_sanitised(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("l order-key"), F.col("l_quantity").alias("qty (units)"), F.col("l_tax").alias("tax")
    )
    return shaping.sanitise_columns(raw.withColumnRenamed("l order-key", "l_order-key"))


@registered("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def select_numeric(spark, sf_dir):
    return shaping.select_types(table(spark, sf_dir, "orders"))


@registered("SELECT event_id, value FROM events")
def dropped_null_cols(spark, sf_dir):
    gaps = table(spark, sf_dir, "events").select(
        "event_id", "value", F.lit(None).cast("double").alias("never"), F.when(F.lit(False), "x").alias("nor_this")
    )
    return shaping.drop_all_null(gaps)


@registered(
    "SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_discount, l_shipdate, "
    "l_returnflag = 'R' AS returned FROM lineitem"
)
def tightened_types(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        "l_quantity",
        F.col("l_discount").cast("string").alias("l_discount"),
        F.col("l_shipdate").cast("string").alias("l_shipdate"),
        (F.col("l_returnflag") == "R").cast("string").alias("returned"),
    )
    return shaping.tighten_types(text)


# --- filters and dedup -------------------------------------------------------------------

@registered(f"WITH {FACT_SQL} SELECT * FROM wind_fact")
def any_measure_not_null(spark, sf_dir):
    return wind_fact(wind_obs(spark, sf_dir))


@registered(f"WITH {WIND_SQL} SELECT time, ff_valor FROM wind_obs WHERE CodigoNacional = 9 AND ff_valor IS NOT NULL")
def one_station(spark, sf_dir):
    series = shaping.one_series(wind_obs(spark, sf_dir), "CodigoNacional", 9.0)
    return shaping.drop_missing(series, "ff_valor").select("time", "ff_valor")


@registered(f"WITH {WIND_SQL} SELECT DISTINCT CodigoNacional, latitud, longitud, nombreEstacion FROM wind_obs")
def distinct_dim(spark, sf_dir):
    return station_dim(wind_obs(spark, sf_dir))


@registered(f"WITH {WIND_SQL} SELECT DISTINCT nombreEstacion FROM wind_obs")
def distinct_list(spark, sf_dir):
    return dedup.distinct_rows(wind_obs(spark, sf_dir), ["nombreEstacion"])


@registered(
    "SELECT *, CAST(ts AS DATE) AS day FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1",
    text=["day"],
)
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dedup.latest_per_key(events, ["user_id", "day"], "ts", ["event_id"])


@registered(
    "SELECT * FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1"
)
def keep_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return dedup.first_per_key(orders, ["o_custkey", "day"], ["o_orderkey"]).drop("day")


# --- rollups -----------------------------------------------------------------------------

@registered(f"""WITH {FACT_SQL}
SELECT CAST(year(time) AS INTEGER) AS anio, CAST(month(time) AS INTEGER) AS mes, CAST(day(time) AS INTEGER) AS dia,
       max(dd_valor) AS dir_racha1, min(dd_valor) AS dir_racha2, round(avg(ff_valor), 9) AS vv_viento_promedio
FROM wind_fact GROUP BY 1, 2, 3""")
def day_rollup(spark, sf_dir):
    rolled = rollup.day_rollup(wind_fact(wind_obs(spark, sf_dir)), year_name="anio")
    return rolled.withColumn("vv_viento_promedio", F.round("vv_viento_promedio", 9))


@registered(f"""WITH {FACT_SQL}
SELECT CAST(year(time) AS INTEGER) AS anno, CAST(month(time) AS INTEGER) AS mes, max(dd_valor) AS Dir_racha1,
       max(dd_valor) AS Dir_racha2, round(avg(ff_valor), 9) AS vv_viento_promedio, CodigoNacional
FROM wind_fact GROUP BY 1, 2, CodigoNacional ORDER BY 1, 2, CodigoNacional""")
def month_rollup(spark, sf_dir):
    rolled = rollup.month_rollup(wind_fact(wind_obs(spark, sf_dir)), digits=9)
    return rolled.orderBy("anno", "mes", "CodigoNacional")


@registered(f"""WITH {FACT_SQL}
SELECT CodigoNacional, CAST(year(time) AS INTEGER) AS anio, CAST(month(time) AS INTEGER) AS mes,
       CAST(day(time) AS INTEGER) AS dia, CAST(time AS DATE) AS fecha, round(avg(ff_valor), 9) AS vviento_promedio
FROM wind_fact GROUP BY 1, 2, 3, 4, 5""", text=["fecha"])
def station_daily_mean(spark, sf_dir):
    return rollup.station_daily_mean(wind_fact(wind_obs(spark, sf_dir)), digits=9)


# --- profiles ----------------------------------------------------------------------------

@registered("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"))


@registered("SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY 2 DESC, 1")
def group_counts(spark, sf_dir):
    return profile.group_counts(table(spark, sf_dir, "events"), ["user_id"])


@registered(f"""WITH {WIND_SQL}
SELECT count(*) - count(time) AS time, count(*) - count(dd_valor) AS dd_valor, count(*) - count(ff_valor) AS ff_valor,
       count(*) - count(VRB_Valor) AS VRB_Valor, count(*) - count(CodigoNacional) AS CodigoNacional FROM wind_obs""")
def null_counts(spark, sf_dir):
    return profile.null_counts(wind_obs(spark, sf_dir).select("time", *MEASURES, "CodigoNacional"))


@registered("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")
))
def describe(spark, sf_dir):
    out = profile.describe(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@registered(f"""WITH {WIND_SQL}
SELECT CodigoNacional, min(time) AS first_time, max(time) AS last_time, count(*) AS n_rows,
       count(*) - count(ff_valor) AS n_missing FROM wind_obs GROUP BY CodigoNacional""")
def series_extent(spark, sf_dir):
    return profile.series_extent(wind_obs(spark, sf_dir), ["CodigoNacional"], "time", "ff_valor")


@registered("SELECT user_id, round(skewness(value), 6) AS value FROM events GROUP BY user_id")
def skew_by_key(spark, sf_dir):
    out = profile.skew_corrected(table(spark, sf_dir, "events"), ["value"], ["user_id"])
    return out.withColumn("value", F.round("value", 6))


@registered("SELECT round(skewness(l_quantity), 6) AS l_quantity, round(skewness(l_extendedprice), 6) AS l_extendedprice, "
            "round(skewness(l_tax), 6) AS l_tax FROM lineitem")
def column_skew(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_tax"]
    out = profile.skew_corrected(table(spark, sf_dir, "lineitem"), cols)
    return out.select(*[F.round(c, 6).alias(c) for c in cols])


@registered("""
SELECT 'l_extendedprice' AS "column", 'mean' AS strategy, round(avg(l_extendedprice), 6) AS value FROM lineitem
UNION ALL SELECT 'value', 'median', round(quantile_cont(value, 0.5), 6) FROM events
UNION ALL SELECT 'l_quantity', 'mode', l_quantity FROM (SELECT l_quantity FROM lineitem GROUP BY 1
                                                 ORDER BY count(*) DESC, l_quantity LIMIT 1) m""")
def impute_stats(spark, sf_dir):
    """Mean, exact median and most frequent value of whole columns."""
    items, events = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "events")
    mean = items.agg(F.avg("l_extendedprice").alias("value")).select(
        F.lit("l_extendedprice").alias("column"), F.lit("mean").alias("strategy"), F.round("value", 6).alias("value")
    )
    middle = exact_medians(events, ["value"])["value"]
    median = spark.createDataFrame([("value", "median", middle)], mean.schema).withColumn("value", F.round("value", 6))
    mode = profile.most_frequent(items, ["l_quantity"]).select(
        "column", F.lit("mode").alias("strategy"), F.col("value").cast("double").alias("value")
    )
    return mean.unionByName(median).unionByName(mode)


# --- order, caps, fills over raw rows ----------------------------------------------------

_ROW_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _row_chunks():
    """Ship day, then a million order keys: some 1,600 rows a chunk at any scale."""
    return [F.col("l_shipdate"), F.floor(F.col("l_orderkey") / 1_000_000)]



@registered(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem ORDER BY {_ROW_ORDER} LIMIT 20000")
def row_cap(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return ordering.first_rows(items, 20000, _ROW_ORDER.split(", "), chunk=_row_chunks())


@registered("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@registered("""
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
       count(*) OVER (PARTITION BY user_id) AS n FROM events""")
def event_positions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return ordering.positions(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@registered("""
SELECT user_id, count(*) FILTER (WHERE pos <= floor(0.8e0 * n)) AS n_train, count(*) FILTER (WHERE pos > floor(0.8e0 * n)) AS n_test,
       max(CASE WHEN pos <= floor(0.8e0 * n) THEN ts END) AS last_train
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
             count(*) OVER (PARTITION BY user_id) AS n FROM events) e GROUP BY user_id""")
def event_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return ordering.ordered_split(events, ["user_id"], ["ts", "event_id"]).groupBy("user_id").agg(
        F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
        F.max(F.when(F.col("is_train"), F.col("ts"))).alias("last_train"),
    )


@registered("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)
         <= count(*) OVER () - floor(0.2e0 * count(*) OVER ()) AS is_train
FROM lineitem""")
def row_holdout(spark, sf_dir):
    """Ordered holdout over the whole table, without any key."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    marked = ordering.ordered_holdout(items, [], _ROW_ORDER.split(", "), chunk=_row_chunks())
    return marked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_train")


@registered(f"""WITH {WIND_SQL}
SELECT event_id, CodigoNacional, time,
       last_value(ff_valor IGNORE NULLS) OVER w AS ff_valor, last_value(VRB_Valor IGNORE NULLS) OVER w AS VRB_Valor
FROM wind_obs WINDOW w AS (PARTITION BY CodigoNacional ORDER BY time, event_id ROWS UNBOUNDED PRECEDING)""")
def forward_fill(spark, sf_dir):
    obs = wind_obs(spark, sf_dir).select("event_id", "CodigoNacional", "time", "ff_valor", "VRB_Valor")
    return ordering.forward_fill(obs, ["ff_valor", "VRB_Valor"], ["CodigoNacional"], ["time", "event_id"])


# --- paged documents ---------------------------------------------------------------------

_RECORD = "o_orderkey BIGINT, o_totalprice DOUBLE, tags ARRAY<STRING>"


def order_pages(spark, sf_dir):
    """Orders as landed pages of one sequence per priority: page n holds the n-th hundred keys.

    In each sequence one page is lost, one is empty and one has no successor, all in its
    second half, at places that differ by sequence.
    """
    orders = table(spark, sf_dir, "orders")
    page = F.floor(F.col("o_orderkey") / 100).cast("bigint")
    record = F.struct("o_orderkey", "o_totalprice", F.array("o_orderstatus", F.lit("x")).alias("tags"))
    docs = orders.groupBy(F.col("o_orderpriority").alias("source"), page.alias("page")).agg(
        F.sort_array(F.collect_list(record)).alias("results")
    )
    last = docs.groupBy("source").agg(F.max("page").alias("last"))

    def at(source: str, share: float):
        """The page this far along the sequence of one source."""
        return (F.col("source") == source) & (F.col("page") == (F.col("last") * F.lit(share)).cast("bigint"))

    following = F.concat(F.lit("page="), (F.col("page") + 1).cast("string"))
    placed = docs.join(last, "source").withColumns(
        {
            "results": F.when(~at("1-URGENT", 0.7), F.col("results")).otherwise(F.slice("results", 1, 0)),
            "next": F.when(~at("2-HIGH", 0.9), following),
        }
    )
    body = F.to_json(F.struct("results", "next")).alias("body")
    return placed.where(~at("3-MEDIUM", 0.8)).select("source", "page", body)


@registered("""
WITH o AS (SELECT *, CAST(floor(o_orderkey / 100.0) AS BIGINT) AS page FROM orders),
last AS (SELECT o_orderpriority, max(page) AS last FROM o GROUP BY 1),
present AS (SELECT DISTINCT o_orderpriority, page FROM o JOIN last USING (o_orderpriority)
            WHERE NOT (o_orderpriority = '3-MEDIUM' AND page = CAST(floor(last * 0.8e0) AS BIGINT))),
absent AS (SELECT p.o_orderpriority, min(p.page + 1) AS stop FROM present p
           LEFT JOIN present q ON q.o_orderpriority = p.o_orderpriority AND q.page = p.page + 1
           WHERE q.page IS NULL AND p.page >= 3 GROUP BY 1),
stops AS (SELECT o_orderpriority, least(stop,
            CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(last * 0.7e0) AS BIGINT) ELSE stop END,
            CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(floor(last * 0.9e0) AS BIGINT) + 1 ELSE stop END) AS stop
          FROM absent JOIN last USING (o_orderpriority))
SELECT o_orderpriority AS source, page, o_orderkey, o_totalprice, o_orderstatus AS first_tag
FROM o JOIN stops USING (o_orderpriority) WHERE page >= 3 AND page < stop""")
def page_take_while(spark, sf_dir):
    records = pages_to_records(order_pages(spark, sf_dir), _RECORD, 3, source="source")
    return records.select("source", "page", "o_orderkey", "o_totalprice", F.col("tags")[0].alias("first_tag"))


# --- tables and jobs ---------------------------------------------------------------------

@registered("SELECT c_mktsegment AS market_segment, count(*) AS n, round(sum(c_acctbal), 4) AS balance FROM customer GROUP BY 1")
def table_round_trip(spark, sf_dir):
    """Land a result under a name with a space, check what was stored, scan it by three-part name."""
    lake = open_lakehouse(spark, run_name(spark, "lh_bronze"), location=run_dir(spark, "lh_bronze"))
    result = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("market segment")).agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 4).alias("balance")
    )
    load_to_new_table(result, f"{lake}.market balance")
    assert_written(result.withColumnRenamed("market segment", "market_segment"), f"{lake}.market balance")
    return scan(spark, f"{lake}.market_balance")


@registered("SELECT n_nationkey AS code, n_name AS label FROM nation")
def replaced_schema(spark, sf_dir):
    """A table is declared, then overwritten with other columns; the new ones stay."""
    lake = open_lakehouse(spark, run_name(spark, "lh_silver"), location=run_dir(spark, "lh_silver"))
    create_table(spark, f"{lake}.lookup", {"id": "STRING", "temp": "DOUBLE"})
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    write_table(nations, f"{lake}.lookup", replace_schema=True)
    return scan(spark, f"{lake}.lookup")


@registered("SELECT p_partkey, p_brand, p_retailprice FROM part")
def path_round_trip(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    return load_path(spark, save_path(parts, run_dir(spark, "part")))


def run_name(spark, label: str) -> str:
    """Lakehouse name that no earlier run of this session has used."""
    return run_dir(spark, label).rsplit("/", 1)[1]


@registered(f"""WITH {FACT_SQL},
per_month AS (SELECT year(time) AS anno, month(time) AS mes, CodigoNacional, max(dd_valor) AS racha,
                     avg(ff_valor) AS vv FROM wind_fact GROUP BY 1, 2, 3),
per_day AS (SELECT CodigoNacional, CAST(time AS DATE) AS fecha, avg(ff_valor) AS vv FROM wind_fact GROUP BY 1, 2)
SELECT 'day' AS layer, count(DISTINCT CAST(time AS DATE)) AS n_rows, CAST(NULL AS DOUBLE) AS total FROM wind_fact
UNION ALL SELECT 'month', count(*), round(sum(vv), 4) FROM per_month
UNION ALL SELECT 'gold', count(*), round(sum(vv), 4) FROM per_day
UNION ALL SELECT 'stations', (SELECT count(*) FROM (SELECT DISTINCT CodigoNacional, latitud, longitud, nombreEstacion FROM wind_obs) d), NULL""")
def medallion_chain(spark, sf_dir):
    """Bronze to silver to gold through tables, each step only after the one before it."""
    tag = run_name(spark, "m")
    lakes = {n: open_lakehouse(spark, f"{n}_{tag}", location=run_dir(spark, n)) for n in ("bronze", "silver", "gold")}
    run_chain([
        lambda: write_table(wind_obs(spark, sf_dir).drop("event_id"), f"{lakes['bronze']}.viento_dmc"),
        lambda: bronze_to_silver(spark, f"{lakes['bronze']}.viento_dmc", lakes["silver"]),
        lambda: silver_rollups(spark, lakes["silver"], digits=9),
        lambda: silver_to_gold(spark, lakes["silver"], lakes["gold"], digits=9),
    ])

    def layer(name, frame, total=None):
        value = F.round(F.sum(total), 4) if total else F.lit(None).cast("double")
        return frame.agg(F.count("*").alias("n_rows"), value.alias("total")).select(F.lit(name).alias("layer"), "n_rows", "total")

    silver = lakes["silver"]
    return (
        layer("day", scan(spark, f"{silver}.ft_viento_anno_mes_dia"))
        .unionByName(layer("month", scan(spark, f"{silver}.ft_viento_anno_mes"), "vv_viento_promedio"))
        .unionByName(layer("gold", scan(spark, f"{lakes['gold']}.ml_train_data_viento_promedio"), "vviento_promedio"))
        .unionByName(layer("stations", scan(spark, f"{silver}.dim_estaciones").select(*STATION_COLUMNS)))
    )
