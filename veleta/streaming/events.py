"""Events whose fields nobody declared, as VARIANT columns (SRC10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.streaming.alerts import AlertRule, alert_struct

# Kinds of values, by the name that Spark gives a VARIANT's type.
KINDS = {"STRING": "text", "BOOLEAN": "flag", "VOID": "null", "OBJECT": "object", "ARRAY": "array"}
COMPARE = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b, "<>": lambda a, b: a != b,
}


def as_events(lines: DataFrame, column: str = "value", out: str = "event") -> DataFrame:
    """JSON text as a VARIANT column; what is no JSON gives NULL and stays readable in `unread`."""
    parsed = F.try_parse_json(F.col(column))
    return lines.withColumn(out, parsed).withColumn("unread", F.when(F.col(out).isNull(), F.col(column)))


def stream_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files of a folder as a stream of events; no schema is asked for."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return as_events(reader.text(path)).drop("value")


def observed_schema(events: DataFrame, event: str = "event") -> str | None:
    """One type that holds every event, as Spark's own aggregate over VARIANT values finds it."""
    return events.agg(F.schema_of_variant_agg(event)).first()[0]


def event_fields(events: DataFrame, event: str = "event", depth: int = 4) -> DataFrame:
    """path, kind and n_events of every field down to `depth` objects.

    Numbers of all widths are one kind. A path has several rows where its values are of several
    kinds. Each level opens the objects of the level before, in one scan; what an array holds is
    not opened.
    """
    spark, level, out = events.sparkSession, events.select(F.lit("$").alias("path"), F.col(event).alias("v")), None
    for _ in range(depth):
        inner = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        named = inner.where(F.col("key").isNotNull())
        step = F.when(F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), "key")).otherwise(
            F.concat(F.lit("['"), "key", F.lit("']"))
        )
        level = named.select(F.concat("path", step).alias("path"), F.col("value").alias("v"))
        out = level if out is None else out.unionByName(level)
    name = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    kind = F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in KINDS.items()], F.when(name.isin("DATE", "TIMESTAMP"), "time"), F.lit("number"))
    return out.groupBy("path", kind.alias("kind")).agg(F.count("*").alias("n_events"))


@dataclass(frozen=True)
class PathRule:
    """A rule on one path of an event: `number` and `text` compare its value with `operand`,
    `present` asks whether the path has a value, `always` fires on every event."""

    path: str = "$"
    kind: str = "always"
    op: str = ">"
    operand: str = ""

    def condition(self, event: str = "event") -> Column:
        """Never NULL: an event without the path, or with a value of another kind, does not fire."""
        if self.kind == "always":
            return F.lit(True)
        if self.kind == "present":
            return F.try_variant_get(F.col(event), self.path, "variant").isNotNull()
        if self.kind not in ("number", "text"):
            raise ValueError(f"no such kind of rule: {self.kind}")
        number = self.kind == "number"
        value = F.try_variant_get(F.col(event), self.path, "double" if number else "string")
        operand = F.lit(float(self.operand)) if number else F.lit(self.operand)
        return F.coalesce(COMPARE[self.op](value, operand), F.lit(False))


def texts_at(paths: Mapping[str, str], event: str = "event") -> dict[str, Column]:
    """Values of paths as text, by their labels, for what an alert tells besides."""
    return {label: F.try_variant_get(F.col(event), path, "string") for label, path in paths.items()}


def alerts_of(events: DataFrame, rules: Mapping[str, AlertRule], keep: Sequence[str | Column] = ()) -> DataFrame:
    """One alert per event and firing rule, all rules in one pass over the events."""
    if not rules:
        rules = {"": AlertRule("", "", [])}
    fired = [
        F.when(rule.condition if rule.condition is not None else F.lit(True), F.struct(F.lit(name).alias("rule_id"), *alert_struct(rule)))
        for name, rule in rules.items()
        if rule.enabled
    ]
    if not fired:
        name, rule = next(iter(rules.items()))
        fired = [F.when(F.lit(False), F.struct(F.lit(name).alias("rule_id"), *alert_struct(rule)))]
    each = events.select(*keep, F.explode(F.array_compact(F.array(*fired))).alias("__alert"))
    return each.select(*[c for c in each.columns if c != "__alert"], "__alert.*")
