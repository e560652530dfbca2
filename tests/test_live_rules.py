"""Schema-less events, rules that change while a stream runs, the progress log and the newest row per key."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from conftest import rows
from veleta.sinks.upsert import read_upserted, upsert
from veleta.streaming import (
    AlertRule, BookRule, PathRule, ProgressLog, RuleBook, alerts_of, as_events, event_fields, keep_newest,
    observed_schema, read_alerts, read_progress, stream_events, watch,
)

ONCE = {"availableNow": True}
LINES = [
    '{"id": 1, "wind": {"speed": 30.5, "from": "N"}}', '{"id": 2, "wind": {"speed": "60"}}', '{"id": 3, "odd key": [1, 2]}',
    '{"id": "4", "wind": null}', "not json", '{"id": 5, "wind": {"speed": 70}, "ok": true}', "7", "",
]


def events(spark):
    return as_events(spark.createDataFrame([(line,) for line in LINES], "value string"))


def test_fields_nobody_declared(spark):
    got = {(r.path, r.kind): r.n_events for r in event_fields(events(spark)).collect()}
    assert got == {
        ("$.id", "number"): 4, ("$.id", "text"): 1, ("$.wind", "object"): 3, ("$.wind", "null"): 1,
        ("$.wind.speed", "number"): 2, ("$.wind.speed", "text"): 1, ("$.wind.from", "text"): 1,
        ("$['odd key']", "array"): 1, ("$.ok", "flag"): 1,
    }
    assert [r.unread for r in events(spark).where("unread IS NOT NULL").orderBy("unread").collect()] == ["", "not json"]
    assert "wind" in observed_schema(events(spark).where("variant_get(event, '$.wind', 'variant') IS NOT NULL AND unread IS NULL"))


def test_rules_on_paths(spark):
    fires = lambda rule: sorted(str(r.id) for r in events(spark).where(rule.condition()).selectExpr("try_variant_get(event, '$.id', 'string') AS id").collect())
    assert fires(PathRule("$.wind.speed", "number", ">", "40")) == ["2", "5"]
    assert fires(PathRule("$.wind.speed", "number", "<=", "40")) == ["1"]
    assert fires(PathRule("$.wind.from", "text", "=", "N")) == ["1"]
    assert fires(PathRule("$['odd key'][1]", "number", "=", "2")) == ["3"]
    assert len(fires(PathRule())) == len(LINES)
    high = AlertRule("high", "h", ["a"], condition=PathRule("$.wind.speed", "number", ">", "40").condition(), enabled=True)
    every = AlertRule("every", "h", ["a"], enabled=True)
    both = alerts_of(events(spark), {"a": high, "b": every, "c": AlertRule("off", "h", ["a"])})
    assert {r.rule_id: r["count"] for r in both.groupBy("rule_id").count().collect()} == {"a": 2, "b": len(LINES)}
    assert alerts_of(events(spark), {}).count() == 0 and alerts_of(events(spark), {"c": AlertRule("off", "h", ["a"])}).count() == 0


def over(limit, **more):
    return {"when": PathRule("$.v", "number", ">", str(limit)), "enabled": True, "sent_to": ["a@example.org"], **more}


def test_rules_change_between_batches(spark, tmp_path):
    inbox, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    book = RuleBook(spark, str(tmp_path / "book"))
    assert book.newest() == {} and book.holding() == []
    land = lambda part: spark.createDataFrame([(json.dumps({"id": i + 100 * part, "v": i}),) for i in range(10)], "value string").coalesce(1).write.mode("append").text(inbox)
    begin = lambda trigger=None: watch(stream_events(spark, inbox), book, out, check, [F.expr("variant_get(event, '$.id', 'int')").alias("id")], trigger=trigger)
    book.publish(BookRule("live", **over(5)), BookRule("still", **over(5)))
    land(0)
    query = begin()
    query.processAllAvailable()
    book.publish(BookRule("live", **over(7, apply_on_update=True)), BookRule("still", **over(7)))
    book.publish(BookRule("added", **over(8, apply_on_update=True)), BookRule("later", **over(8)))
    land(1)
    query.processAllAvailable()
    book.publish(BookRule("live", **over(0, apply_on_update=False)), BookRule("added", enabled=False, apply_on_update=True))
    land(2)
    query.processAllAvailable()
    query.stop()
    land(3)
    begin(ONCE).awaitTermination()
    got = {}
    for r in read_alerts(spark, out).collect():
        got.setdefault((r.id // 100, r.rule_id, r.version), []).append(r.id % 100)
    got = {k: min(v) for k, v in got.items()}
    assert got == {
        (0, "live", 1): 6, (0, "still", 1): 6,
        (1, "live", 2): 8, (1, "still", 1): 6, (1, "added", 1): 9,
        (2, "live", 2): 8, (2, "still", 1): 6,
        (3, "live", 3): 1, (3, "still", 2): 8, (3, "later", 1): 9,
    }
    # A batch whose commit was lost applies the rules it had, whatever was published since.
    before = read_alerts(spark, out).count()
    for name in ("3", ".3.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    book.publish(BookRule("still", **over(-1, apply_on_update=True)))
    begin(ONCE).awaitTermination()
    assert read_alerts(spark, out).count() == before


def test_every_batch_is_logged(spark, tmp_path):
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    inbox.mkdir()
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        for run, first in enumerate((0, 40)):
            for i in range(first, first + 40):
                (inbox / f"{i}.txt").write_text(f"{i}\n" * (i + 1))
            with ProgressLog(spark, log, every=7) as listener:
                stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(inbox))
                query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).queryName(f"q{run}").trigger(**ONCE).start()
                query.awaitTermination()
                assert len(query.recentProgress) <= 10 and listener.settled(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    got = read_progress(spark, log).where("input_rows > 0")
    assert got.count() == 80 and got.agg(F.sum("input_rows")).first()[0] == sum(range(1, 81))
    assert got.select("query_id").distinct().count() == 1 and got.select("run_id").distinct().count() == 2


def deliveries(n, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [(start + dt.timedelta(hours=rng.randrange(60)), rng.choice("abc"), i, f"p{i}") for i in range(n)]


SCHEMA = "hour timestamp, place string, seen int, payload string"


def newest(data):
    best = {}
    for hour, place, seen, payload in data:
        best[hour, place] = max(best.get((hour, place), (-1, "")), (seen, payload))
    return sorted((h, p, *v) for (h, p), v in best.items())


def test_newest_row_per_key_of_a_stream(spark, tmp_path):
    data = deliveries(400, 1)
    for delay in (None, "90 hours"):
        folder = tmp_path / (delay or "none").replace(" ", "")
        inbox, out = str(folder / "in"), str(folder / "out")
        # The later half first, then the earlier half and repeats.
        for part in (data[200:], data[:200], data[150:250]):
            spark.createDataFrame(part, SCHEMA).coalesce(3).write.mode("append").parquet(inbox)
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(inbox)
            keep_newest(
                stream, out, str(folder / "check"), ["hour", "place"], "seen", F.date_format("hour", "yyyyMMdd"),
                event_time="hour", delay=delay, tiebreak=["payload"], trigger=ONCE,
            ).awaitTermination()
        assert rows(read_upserted(spark, out), "hour", "place") == newest(data)


def test_upsert_rewrites_only_what_it_touches(spark, tmp_path):
    out = str(tmp_path / "t")
    data = deliveries(300, 2)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    merge = lambda part: upsert(frame(part), out, ["hour", "place"], "seen", F.date_format("hour", "yyyyMMdd"))
    merge(data)
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    late = [(dt.datetime(2024, 1, 2, 5), "a", 999, "new"), (dt.datetime(2024, 1, 2, 6), "a", -5, "old")]
    merge(late)
    merge(late)
    after = files()
    kept = [f for f in before if after.get(f) == before[f]]
    assert kept and not any("20240102" in str(f) for f in kept) and all("20240102" in str(f) for f in set(before) - set(kept))
    assert rows(read_upserted(spark, out), "hour", "place") == newest(data + late)
