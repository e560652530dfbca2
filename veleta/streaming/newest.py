"""The newest row of every key, kept up to date by a stream (SCR7, DST2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veleta.operators.dedup import latest_per_key
from veleta.sinks.upsert import upsert


def keep_newest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newest: str,
    part: Column,
    event_time: str | None = None,
    delay: str | None = None,
    tiebreak: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Stream rows into a table of the newest row per key.

    Without `delay` every batch is reduced to its newest rows and merged, so the table itself is
    the state and rows may come late by any time. With `delay` a stateful aggregation holds the
    newest row of every key until `event_time`, one of the keys, is older than the watermark;
    batches then merge only keys that changed, and rows later than the delay are left out.
    """
    if delay is not None:
        if event_time not in keys:
            raise ValueError("a watermark needs the event time among the keys")
        rank = F.struct(newest, *tiebreak)
        others = F.struct(*[c for c in rows.columns if c not in keys])
        held = rows.withWatermark(event_time, delay).groupBy(*keys).agg(F.max_by(others, rank).alias("__row"))
        rows = held.select(*keys, "__row.*").select(*rows.columns)

    def write(batch: DataFrame, _: int) -> None:
        upsert(latest_per_key(batch, keys, newest, tiebreak), path, keys, newest, part, tiebreak)

    writer = rows.writeStream.outputMode("append" if delay is None else "update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()
