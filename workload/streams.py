"""Streaming ingest and alerts over files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from veleta.session import run_dir
from veleta.sinks import open_lakehouse
from veleta.sources import scan
from veleta.plans.running_score import RESULT_COLUMNS, running_score
from veleta.sinks.upsert import read_upserted
from veleta.streaming import (
    AlertRule, BookRule, PathRule, ProgressLog, RuleBook, alerts, alerts_of, append_merging, append_stream, as_events,
    event_fields, ingest_messages, keep_newest, progress_frame, read_alerts, read_merged, read_progress, stream_events,
    stream_json, watch,
)
from workload.adapters import SCORED_SQL, table, weather_obs
from workload.registry import registered

ONCE = {"availableNow": True}
MESSAGE = "id STRING, temp DOUBLE, humedad DOUBLE, vviento DOUBLE, timestamp TIMESTAMP"


def _messages(spark, sf_dir):
    """Events as sensor messages, times as zone-less text."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("m-"), F.col("event_id").cast("string")).alias("id"),
        (F.col("event_id") % 41 - 2).cast("double").alias("temp"),
        F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 10 / F.lit(10.0)).alias("humedad"),
        F.round("value", 0).alias("vviento"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type"),
        F.dayofmonth("ts").alias("day"),
    )


# Files per micro-batch; a limit of one would make a batch of every file of a large table.
LIMIT = 500


def _land(messages, path):
    """Write messages as JSON files, as many as Spark has partitions."""
    messages.write.mode("append").json(path)


@registered("""
SELECT 'm-' || CAST(event_id AS VARCHAR) AS id, CAST(event_id % 41 - 2 AS DOUBLE) AS temp,
       CASE WHEN event_id % 9 <> 0 THEN (event_id % 10) / 10.0e0 END AS humedad, round(value, 0) AS vviento,
       ts AS ts_registro FROM events""")
def stream_ingest(spark, sf_dir):
    """Messages streamed into a table; a second run on the same checkpoint adds nothing."""
    folder = run_dir(spark, "sensor")
    lake = open_lakehouse(spark, folder.rsplit("/", 1)[1], location=f"{folder}/tables")
    _land(_messages(spark, sf_dir).drop("event_type", "day"), f"{folder}/in")
    for _ in range(2):
        ingest_messages(
            spark, f"{folder}/in", f"{lake}.sensores", f"{folder}/checkpoint", MESSAGE,
            files_per_trigger=LIMIT, trigger=ONCE,
        ).awaitTermination()
    return scan(spark, f"{lake}.sensores").where("ts_process IS NOT NULL").drop("ts_process")


@registered("""
SELECT 'm-' || CAST(event_id AS VARCHAR) AS id, CASE WHEN day(ts) > 15 THEN event_type END AS event_type,
       CAST(NULL AS VARCHAR) AS firmware, CAST(event_id % 41 - 2 AS DOUBLE) AS temp FROM events""")
def stream_schema_merge(spark, sf_dir):
    """Messages of the second half of the month bring a column that the first half lacks."""
    folder = run_dir(spark, "merge")
    all_messages = _messages(spark, sf_dir)
    early = all_messages.where("day <= 15").select("id", "temp")
    late = all_messages.where("day > 15").select("id", "temp", "event_type")
    for part, schema in ((early, "id STRING, temp DOUBLE"), (late, "id STRING, temp DOUBLE, event_type STRING")):
        _land(part, f"{folder}/in")
        source = stream_json(spark, f"{folder}/in", schema, LIMIT)
        append_merging(source, f"{folder}/out", f"{folder}/checkpoint", ONCE).awaitTermination()
    declared = {"id": "STRING", "firmware": "STRING"}
    return read_merged(spark, f"{folder}/out", declared)


@registered("""
SELECT 'm-' || CAST(event_id AS VARCHAR) AS id, CASE WHEN day(ts) <= 10 THEN CAST(event_id % 100 AS DOUBLE) ELSE event_id / 4.0e0 END AS reading,
       CASE WHEN day(ts) <= 20 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS code FROM events""")
def stream_widened_types(spark, sf_dir):
    """Whole numbers, then fractions, then text for a code: each run has its types, readers see one."""
    folder = run_dir(spark, "widened")
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("m-"), F.col("event_id").cast("string")).alias("id"), "event_id", "user_id", "event_type", F.dayofmonth("ts").alias("day")
    )
    parts = [
        ("day <= 10", (F.col("event_id") % 100).cast("int"), F.col("user_id"), "id STRING, reading INT, code BIGINT"),
        ("day > 10 AND day <= 20", F.col("event_id") / 4, F.col("user_id"), "id STRING, reading DOUBLE, code BIGINT"),
        ("day > 20", F.col("event_id") / 4, F.col("event_type"), "id STRING, reading DOUBLE, code STRING"),
    ]
    for days, reading, code, schema in parts:
        _land(e.where(days).select("id", reading.alias("reading"), code.alias("code")), f"{folder}/in")
        append_merging(stream_json(spark, f"{folder}/in", schema, LIMIT), f"{folder}/out", f"{folder}/checkpoint", ONCE).awaitTermination()
    return read_merged(spark, f"{folder}/out")


@registered("SELECT count(*) AS n_rows, true AS stamped FROM events")
def stream_progress(spark, sf_dir):
    """Rows read, as the progress entries tell them; without a file limit there is one batch."""
    folder = run_dir(spark, "progress")
    _land(_messages(spark, sf_dir).select("id", "temp"), f"{folder}/in")
    source = stream_json(spark, f"{folder}/in", "id STRING, temp DOUBLE", None)
    lake = open_lakehouse(spark, folder.rsplit("/", 1)[1], location=f"{folder}/tables")
    running = append_stream(source, f"{lake}.t", f"{folder}/checkpoint", trigger=ONCE)
    running.awaitTermination()
    return progress_frame(spark, running).where("input_rows > 0").agg(
        F.sum("input_rows").alias("n_rows"), F.every(F.col("started").isNotNull()).alias("stamped")
    )


@registered("""
SELECT event_id, 'Valor alto' AS subject, 'El valor pasa de 50.' AS headline FROM events WHERE value > 50""")
def stream_alerts(spark, sf_dir):
    """The same rule as over a table, on a stream of the event files."""
    folder = run_dir(spark, "alerts")
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")
    rule = AlertRule("Valor alto", "El valor pasa de 50.", ["guardia@example.org"], condition=F.col("value") > 50, enabled=True)
    append_merging(
        alerts(stream, rule, keep=["event_id"]), f"{folder}/out", f"{folder}/checkpoint", ONCE
    ).awaitTermination()
    return read_merged(spark, f"{folder}/out").select("event_id", "subject", "headline")


def _lines(spark, sf_dir):
    """Events as JSON text whose fields depend on the kind of event, and the day of the month."""
    e = table(spark, sf_dir, "events")
    head = F.col("event_id").alias("id")
    inner = lambda *c: F.to_json(F.struct(head, *c))
    line = (
        F.when(F.col("event_type") == "click", inner(F.struct("value", F.col("user_id").alias("user")).alias("click")))
        .when(F.col("event_type") == "error", inner(F.struct((F.col("user_id") % 7).alias("code")).alias("error")))
        .otherwise(inner(F.col("event_type").alias("kind"), "value"))
    )
    return e.select(line.alias("value"), F.dayofmonth("ts").alias("day"))


def _id():
    return F.try_variant_get(F.col("event"), "$.id", "bigint").alias("event_id")


@registered("""
SELECT * FROM (
  SELECT '$.id' AS path, 'number' AS kind, count(*) AS n_events FROM events
  UNION ALL SELECT '$.click', 'object', count(*) FROM events WHERE event_type = 'click'
  UNION ALL SELECT '$.click.value', 'number', count(value) FROM events WHERE event_type = 'click'
  UNION ALL SELECT '$.click.user', 'number', count(user_id) FROM events WHERE event_type = 'click'
  UNION ALL SELECT '$.error', 'object', count(*) FROM events WHERE event_type = 'error'
  UNION ALL SELECT '$.error.code', 'number', count(user_id) FROM events WHERE event_type = 'error'
  UNION ALL SELECT '$.kind', 'text', count(event_type) FROM events WHERE event_type NOT IN ('click', 'error')
  UNION ALL SELECT '$.value', 'number', count(value) FROM events WHERE event_type NOT IN ('click', 'error')
) WHERE n_events > 0""")
def event_field_kinds(spark, sf_dir):
    """What fields events have that come without a schema."""
    return event_fields(as_events(_lines(spark, sf_dir)))


@registered("""
SELECT event_id, 'strong click' AS rule_id, 'Clic fuerte' AS subject, ['value: ' || CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR)] AS extra
FROM events WHERE event_type = 'click' AND value > 50
UNION ALL SELECT event_id, 'any error', 'Error', [] FROM events WHERE event_type = 'error' AND user_id IS NOT NULL
UNION ALL SELECT event_id, 'purchase', 'Compra', [] FROM events WHERE event_type = 'purchase'""")
def schemaless_alerts(spark, sf_dir):
    """A stream of events without a schema becomes alert rows by rules on paths."""
    folder = run_dir(spark, "schemaless")
    _lines(spark, sf_dir).select("value").write.text(f"{folder}/in")
    value = F.try_variant_get(F.col("event"), "$.click.value", "double").cast("decimal(18,2)")
    rules = {
        "strong click": AlertRule("Clic fuerte", "", [], extra={"value": value}, condition=PathRule("$.click.value", "number", ">", "50").condition(), enabled=True),
        "any error": AlertRule("Error", "", [], condition=PathRule("$.error.code", "present").condition(), enabled=True),
        "purchase": AlertRule("Compra", "", [], condition=PathRule("$.kind", "text", "=", "purchase").condition(), enabled=True),
        "off": AlertRule("No", "", []),
    }
    fired = alerts_of(stream_events(spark, f"{folder}/in", LIMIT), rules, [_id()])
    append_merging(fired, f"{folder}/out", f"{folder}/checkpoint", ONCE).awaitTermination()
    return read_merged(spark, f"{folder}/out").select("event_id", "rule_id", "subject", "extra")


@registered("""
WITH v AS (SELECT event_id, value, CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END AS part
           FROM events WHERE event_type NOT IN ('click', 'error'))
SELECT event_id, 'live' AS rule_id, CASE WHEN part = 1 THEN 1 ELSE 2 END AS version FROM v WHERE value > CASE WHEN part = 1 THEN 50 ELSE 80 END
UNION ALL
SELECT event_id, 'restart', CASE WHEN part < 3 THEN 1 ELSE 2 END FROM v WHERE value > CASE WHEN part < 3 THEN 50 ELSE 80 END""")
def alerts_rule_changes(spark, sf_dir):
    """Both rules change after the first part: one holds from the next batch, the other once the stream starts anew."""
    folder = run_dir(spark, "rules")
    book, lines = RuleBook(spark, f"{folder}/book"), _lines(spark, sf_dir)
    over = lambda limit, **more: {"when": PathRule("$.value", "number", ">", str(limit)), "enabled": True, **more}
    land = lambda days: lines.where(days).select("value").write.mode("append").text(f"{folder}/in")
    begin = lambda trigger=None: watch(
        stream_events(spark, f"{folder}/in", LIMIT), book, f"{folder}/out", f"{folder}/checkpoint", [_id()], trigger=trigger
    )
    book.publish(BookRule("live", **over(50)), BookRule("restart", **over(50)))
    land("day <= 10")
    running = begin()
    running.processAllAvailable()
    book.publish(BookRule("live", **over(80, apply_on_update=True)), BookRule("restart", **over(80)))
    land("day > 10 AND day <= 20")
    running.processAllAvailable()
    running.stop()
    land("day > 20")
    begin(ONCE).awaitTermination()
    return read_alerts(spark, f"{folder}/out").select("event_id", "rule_id", "version")


@registered("SELECT 24 AS n_batches, 2 AS n_runs, count(*) AS n_rows FROM events")
def stream_progress_log(spark, sf_dir):
    """A row for every batch of two runs of a stream, read from the log."""
    folder = run_dir(spark, "progress-log")
    messages = _messages(spark, sf_dir)
    for half in ("day <= 15", "day > 15"):
        messages.where(half).select("id", "temp").repartition(12).write.mode("append").json(f"{folder}/in")
        with ProgressLog(spark, f"{folder}/log", every=5) as log:
            source = stream_json(spark, f"{folder}/in", "id STRING, temp DOUBLE", 1)
            running = append_merging(source, f"{folder}/out", f"{folder}/checkpoint", ONCE)
            running.awaitTermination()
            log.settled(running)
    entries = read_progress(spark, f"{folder}/log").where("input_rows > 0")
    return entries.agg(
        F.count("*").cast("int").alias("n_batches"), F.countDistinct("run_id").cast("int").alias("n_runs"), F.sum("input_rows").alias("n_rows")
    )


@registered("WITH " + SCORED_SQL.replace("{where}", "") + " SELECT " + ", ".join(RESULT_COLUMNS) + " FROM labelled")
def stream_newest_scored(spark, sf_dir):
    """Deliveries stream in, late and repeated, into a table of the newest one per hour, which is then scored."""
    folder = run_dir(spark, "newest")
    obs = weather_obs(spark, sf_dir)
    late = F.col("_ingested") % 3 == 0
    for part in (obs.where(~late), obs.where(late), obs.where(F.col("_ingested") % 10 == 0)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", LIMIT).parquet(f"{folder}/in")
        keep_newest(
            stream, f"{folder}/table", f"{folder}/checkpoint", ["dateTime"], "_ingested", F.substring("dateTime", 1, 10), trigger=ONCE
        ).awaitTermination()
    return running_score(read_upserted(spark, f"{folder}/table"), all_days=True)
