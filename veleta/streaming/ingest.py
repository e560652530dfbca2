"""Micro-batch ingest of JSON files (SRC4, SNK5-6, STM1-2, STM4)."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veleta.functions.naming import catalog_name
from veleta.sinks.tables import create_table

# Layout of the sensor messages and of the table they are appended to.
SENSOR_SCHEMA = "id STRING, temp DOUBLE, humedad DOUBLE, vviento DOUBLE, timestamp TIMESTAMP"
SENSOR_COLUMNS = {
    "id": "STRING",
    "temp": "DOUBLE",
    "humedad": "DOUBLE",
    "vviento": "DOUBLE",
    "ts_registro": "TIMESTAMP",
    "ts_process": "TIMESTAMP",
}


def stream_json(
    spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int | None = 1, **options: str
) -> DataFrame:
    """JSON files of a folder as a stream. Fields that cannot be read become NULL.

    One file per batch is the gentle default; raise it, or pass None for no limit, when many
    small files arrive, since each batch has a fixed cost.
    """
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stamp(sdf: DataFrame, out: str = "ts_process") -> DataFrame:
    """Append the processing time; it is the same for all rows of a micro-batch (STM2)."""
    return sdf.withColumn(out, F.current_timestamp())


def _start(writer, trigger: Mapping[str, object] | None, begin) -> StreamingQuery:
    return begin(writer.trigger(**trigger) if trigger else writer)


def append_stream(
    sdf: DataFrame,
    table: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
    merge_schema: bool = False,
) -> StreamingQuery:
    """Append a stream to a table; the checkpoint makes every file count once (SNK5, STM4).

    `trigger` takes the arguments of DataStreamWriter.trigger, for example
    {"availableNow": True}; None runs until stopped. Schema merge on the table itself needs a
    format that can do it; see `append_merging` for parquet.
    """
    writer = sdf.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if merge_schema:
        if fmt != "delta":
            raise ValueError("only delta tables merge schemas on write; use append_merging")
        writer = writer.option("mergeSchema", "true")
    return _start(writer, trigger, lambda w: w.toTable(catalog_name(table)))


# Partition columns of `append_merging`, named so that they meet no column of a message.
_SCHEMA, _STREAM, _BATCH = "ingest__schema", "ingest__stream", "ingest__batch"
_SCHEMAS = "written bigint, ddl string, ingest__schema string, ingest__stream string, ingest__batch bigint"


def append_merging(
    sdf: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Append to a parquet folder whose schema may change between runs (SNK6).

    Each batch owns a partition named by its schema, its stream and its number, and overwrites it,
    so a batch that is repeated after a failure leaves the same rows. Numbers restart with a new
    checkpoint, so the checkpoint tells streams apart. What schema a batch has is kept beside the
    folder; a batch that is repeated with another one counts with the later one. `read_merged`
    unites the schemas, also where a column has other types.
    """
    stream = f"s{md5(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        ddl = batch.schema.json()
        schema = f"c{md5(ddl.encode()).hexdigest()[:16]}"
        batch.write.mode("overwrite").parquet(f"{path}/{_SCHEMA}={schema}/{_STREAM}={stream}/{_BATCH}={batch_id}")
        entry = [(time.time_ns(), ddl, schema, stream, batch_id)]
        batch.sparkSession.createDataFrame(entry, _SCHEMAS).coalesce(1).write.mode("append").parquet(f"{path}.schemas")

    writer = sdf.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(writer, trigger, lambda w: w.start())


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: whole numbers, double, text; date, timestamp, text."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: [k for k, w in enumerate(_WHOLE) if isinstance(t, w)][0])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType)
    return T.TimestampType() if isinstance(a, times) and isinstance(b, times) else T.StringType()


def read_merged(spark: SparkSession, path: str, declared: Mapping[str, str] | None = None) -> DataFrame:
    """All batches under one schema: declared columns first, then those that came later.

    The files of each schema are read as they were written and then cast to the widest type of
    each column. A column that a batch, or every batch, lacks is NULL.
    """
    log = spark.read.schema(_SCHEMAS).parquet(f"{path}.schemas")
    last = log.groupBy(_STREAM, _BATCH).agg(F.max_by(F.struct("ddl", _SCHEMA), "written").alias("w")).select(_STREAM, _BATCH, "w.*")
    # One row for each schema that messages ever had.
    schemas = {r[_SCHEMA]: T.StructType.fromJson(json.loads(r["ddl"])) for r in last.groupBy(_SCHEMA, "ddl").agg(F.min(_BATCH).alias("b")).orderBy("b", _SCHEMA).collect()}
    types: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in schema:
            types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
    out = None
    for name, schema in schemas.items():
        own = T.StructType([*schema, T.StructField(_STREAM, T.StringType()), T.StructField(_BATCH, T.LongType())])
        stored = spark.read.schema(own).parquet(f"{path}/{_SCHEMA}={name}")
        kept = stored.join(last.where(F.col(_SCHEMA) == name).select(_STREAM, _BATCH), [_STREAM, _BATCH], "left_semi")
        held = set(schema.names)
        one = kept.select(*[(F.col(f"`{c}`").cast(t) if c in held else F.lit(None).cast(t)).alias(c) for c, t in types.items()])
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], T.StructType())
    if not declared:
        return out
    first = [(F.col(c).cast(t) if c in out.columns else F.lit(None).cast(t)).alias(c) for c, t in declared.items()]
    return out.select(*first, *[c for c in out.columns if c not in declared])


def ingest_messages(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    schema: StructType | str = SENSOR_SCHEMA,
    columns: Mapping[str, str] = SENSOR_COLUMNS,
    rename: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    files_per_trigger: int | None = 1,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Create the table when needed, then stream JSON messages into it (STM1).

    `rename` maps message fields to table columns; the default moves `timestamp` to
    `ts_registro`, which would otherwise stay empty. Table columns that no message has are NULL.
    """
    create_table(spark, table, columns, fmt)
    rename = {"timestamp": "ts_registro"} if rename is None else rename
    messages = stamp(stream_json(spark, source, schema, files_per_trigger)).withColumnsRenamed(dict(rename))
    aligned = messages.select(
        *[
            F.col(c) if c in messages.columns else F.lit(None).cast(t).alias(c)
            for c, t in columns.items()
        ]
    )
    return append_stream(aligned, table, checkpoint, fmt, trigger)
