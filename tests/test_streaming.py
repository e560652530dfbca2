import json
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from veleta.sources import scan
from veleta.streaming import (
    AlertRule, alerts, append_merging, append_stream, ingest_messages, progress_frame, read_merged, stamp, status_of,
    stream_json,
)

ONCE = {"availableNow": True}


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text if isinstance(text, str) else json.dumps(text))


def message(i, **changes):
    return {"id": f"m{i}", "temp": 1.5 + i, "humedad": 0.4, "vviento": 6.0, "timestamp": f"2024-01-01T12:00:{i:02d}.123456", **changes}


def test_ingest_counts_every_file_once(spark, tmp_path, lake):
    inbox, table, check = tmp_path / "in", f"{lake('lh')}.sensores", str(tmp_path / "check")
    for i in range(12):
        put(inbox, f"sensor_{i}.json", message(i))
    start = lambda: ingest_messages(spark, str(inbox), table, check, trigger=ONCE)
    q = start()
    q.awaitTermination()
    progress = progress_frame(spark, q).where("input_rows > 0")
    assert progress.count() == 12 and progress.agg(F.sum("input_rows")).first()[0] == 12
    assert status_of(q)["is_running"] is False
    stored = scan(spark, table)
    assert stored.columns == ["id", "temp", "humedad", "vviento", "ts_registro", "ts_process"]
    assert stored.count() == 12 and stored.where("ts_registro IS NULL OR ts_process IS NULL").count() == 0
    assert str(stored.orderBy("id").first()["ts_registro"]) == "2024-01-01 12:00:00.123456"

    start().awaitTermination()
    assert scan(spark, table).count() == 12
    put(inbox, "sensor_12.json", message(12, extra="ignored"))
    put(inbox, "sensor_13.json", {"id": "m13"})
    put(inbox, "sensor_14.json", "{not json")
    start().awaitTermination()
    spark.catalog.refreshTable(table.replace(".", "__", 1))
    got = scan(spark, table)
    assert got.count() == 15 and got.where("id IS NULL AND temp IS NULL").count() == 1


def test_without_rename_the_declared_time_stays_empty(spark, tmp_path, lake):
    put(tmp_path / "in", "a.json", message(1))
    table = f"{lake('lh2')}.t"
    ingest_messages(spark, str(tmp_path / "in"), table, str(tmp_path / "c"), rename={}, trigger=ONCE).awaitTermination()
    assert scan(spark, table).first()["ts_registro"] is None


def test_schema_merge_and_repeated_batches(spark, tmp_path):
    inbox, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    put(inbox, "a.json", {"id": "a", "temp": 1.0})
    run = lambda schema: append_merging(
        stream_json(spark, str(inbox), schema), out, check, ONCE
    ).awaitTermination()
    run("id STRING, temp DOUBLE")
    put(inbox, "b.json", {"id": "b", "temp": 2.0, "hum": 0.5})
    run("id STRING, temp DOUBLE, hum DOUBLE")
    merged = read_merged(spark, out, {"id": "STRING", "ts": "TIMESTAMP"})
    assert merged.columns == ["id", "ts", "temp", "hum"]
    assert rows(merged, "id") == [("a", None, 1.0, None), ("b", None, 2.0, 0.5)]

    # A batch whose commit was lost is run again and leaves the same rows.
    (tmp_path / "check" / "commits" / "1").unlink()
    (tmp_path / "check" / "commits" / ".1.crc").unlink(missing_ok=True)
    run("id STRING, temp DOUBLE, hum DOUBLE")
    assert read_merged(spark, out).count() == 2


def test_merge_on_write_needs_a_format_that_can(spark, tmp_path):
    put(tmp_path / "in", "a.json", {"id": "a"})
    with pytest.raises(ValueError):
        append_stream(stream_json(spark, str(tmp_path / "in"), "id STRING"), "t", str(tmp_path / "c"), merge_schema=True)


def test_continuous_query_reports_and_stops(spark, tmp_path, lake):
    put(tmp_path / "in", "a.json", {"id": "a"})
    q = append_stream(stamp(stream_json(spark, str(tmp_path / "in"), "id STRING")), f"{lake('lh3')}.t", str(tmp_path / "c"))
    assert status_of(q)["is_running"]
    q.processAllAvailable()
    deadline = time.monotonic() + 30
    while status_of(q)["last_batch"] is None and time.monotonic() < deadline:
        time.sleep(0.1)
    assert status_of(q)["last_batch"] == 0
    q.stop()
    assert not status_of(q)["is_running"]


def test_alerts(spark, tmp_path):
    events = spark.createDataFrame([(1, 5.0), (2, 50.0), (3, None)], "event_id bigint, value double")
    rule = AlertRule("s", "h", ["a@example.org", "b@example.org"], message="m", extra={"v": F.col("value")}, enabled=True)
    got = alerts(events, rule, keep=["event_id"])
    assert got.count() == 3
    first = got.orderBy("event_id").first()
    assert first["sent_to"] == ["a@example.org", "b@example.org"] and first["copy_to"] == [] and first["extra"] == ["v: 5.0"]
    assert alerts(events, AlertRule("s", "h", ["a"])).count() == 0
    above = AlertRule("s", "h", ["a"], condition=F.col("value") > 10, enabled=True)
    assert rows(alerts(events, above, keep=["event_id"]).select("event_id")) == [(2,)]

    path = str(tmp_path / "events")
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    assert stream.isStreaming and alerts(stream, above).isStreaming
    append_merging(alerts(stream, above, keep=["event_id"]), str(tmp_path / "out"), str(tmp_path / "c"), ONCE).awaitTermination()
    assert [r["event_id"] for r in read_merged(spark, str(tmp_path / "out")).collect()] == [2]


def test_columns_that_change_their_type(spark, tmp_path):
    inbox, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda schema: append_merging(stream_json(spark, str(inbox), schema), out, check, ONCE).awaitTermination()
    steps = [
        ({"id": 1, "v": 2**53 + 1, "d": "2024-01-01"}, "id BIGINT, v BIGINT, d DATE"),
        ({"id": 2, "v": 7, "d": "2024-01-02T03:04:05"}, "id INT, v INT, d TIMESTAMP"),
    ]
    for k, (row, schema) in enumerate(steps):
        put(inbox, f"{k}.json", row)
        run(schema)
    both = read_merged(spark, out)
    assert both.dtypes == [("id", "bigint"), ("v", "bigint"), ("d", "timestamp")]
    assert [(r.id, r.v, str(r.d)) for r in both.orderBy("id").collect()] == [(1, 2**53 + 1, "2024-01-01 00:00:00"), (2, 7, "2024-01-02 03:04:05")]
    put(inbox, "2.json", {"id": 3, "v": 0.5})
    run("id BIGINT, v DOUBLE")
    put(inbox, "3.json", {"id": 4, "v": "high", "new": True})
    run("id BIGINT, v STRING, new BOOLEAN")
    got = read_merged(spark, out)
    assert got.dtypes == [("id", "bigint"), ("v", "string"), ("d", "timestamp"), ("new", "boolean")]
    assert [(r.id, r.v, r.new) for r in got.orderBy("id").collect()] == [(1, str(2**53 + 1), None), (2, "7", None), (3, "0.5", None), (4, "high", True)]

    # A batch that is repeated after a failure with another schema is there once.
    for name in ("3", ".3.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    run("id BIGINT, v STRING")
    assert rows(read_merged(spark, out).select("id"), "id") == [(1,), (2,), (3,), (4,)]
