"""Alert rules that change while a stream runs (STM5-6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veleta.streaming.alerts import AlertRule
from veleta.streaming.events import PathRule, alerts_of, texts_at

VERSIONS = (
    "rule_id string, version int, path string, kind string, op string, operand string, subject string, headline string, "
    "message string, sent_to array<string>, copy_to array<string>, blind_copy_to array<string>, extra map<string,string>, "
    "locale string, enabled boolean, apply_on_update boolean"
)
_NAMES = [c.split()[0] for c in VERSIONS.split(", ")]
# Every rule of a book is part of one expression over an event.
MOST_RULES = 500


@dataclass(frozen=True)
class BookRule:
    """A rule as a row of a book. `apply_on_update` says whether this version of it holds for
    streams that are running when it is published, or only for those started later."""

    rule_id: str
    when: PathRule = PathRule()
    subject: str = ""
    headline: str = ""
    sent_to: Sequence[str] = ()
    copy_to: Sequence[str] = ()
    blind_copy_to: Sequence[str] = ()
    message: str = ""
    extra: Mapping[str, str] = field(default_factory=dict)
    locale: str = "en-us"
    enabled: bool = False
    apply_on_update: bool = False
    version: int = 0

    def row(self) -> tuple:
        w = self.when
        return (
            self.rule_id, self.version, w.path, w.kind, w.op, w.operand, self.subject, self.headline, self.message,
            list(self.sent_to), list(self.copy_to), list(self.blind_copy_to), dict(self.extra), self.locale,
            self.enabled, self.apply_on_update,
        )

    @classmethod
    def of(cls, row) -> BookRule:
        values = row.asDict()
        when = PathRule(*[values.pop(n) for n in ("path", "kind", "op", "operand")])
        return cls(when=when, **values)

    def alert_rule(self, event: str) -> AlertRule:
        return AlertRule(
            self.subject, self.headline, self.sent_to, self.copy_to, self.blind_copy_to, self.message,
            texts_at(self.extra, event), self.locale, self.when.condition(event), self.enabled,
        )


class RuleBook:
    """Versions of rules in a folder that is only ever added to; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def stored(self) -> DataFrame | None:
        """All versions of all rules; None where there is no book."""
        try:
            return self.spark.read.schema(VERSIONS).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def versions(self) -> DataFrame:
        """All versions of all rules; none where nothing was published."""
        stored = self.stored()
        return self.spark.createDataFrame([], VERSIONS) if stored is None else stored

    def newest(self) -> dict[str, int]:
        """Newest version of every rule."""
        return {r[0]: r[1] for r in self.versions().groupBy("rule_id").agg(F.max("version")).limit(MOST_RULES + 1).collect()}

    def publish(self, *rules: BookRule) -> None:
        """Add the next version of each rule, all in one file, so readers see all or none."""
        last = self.newest()
        rows = []
        for rule in rules:
            last[rule.rule_id] = last.get(rule.rule_id, 0) + 1
            rows.append(BookRule(**{**rule.__dict__, "version": last[rule.rule_id]}).row())
        if len(last) > MOST_RULES:
            raise ValueError(f"a book holds {MOST_RULES} rules at most")
        self.spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(self.path)

    def holding(self, pinned: Mapping[str, int] | None = None) -> list[BookRule]:
        """The version of each rule that holds: the newest.

        For a stream that began when the versions `pinned` were the newest, it is the newest among
        those and the later ones that apply on update. A rule with neither does not hold yet.
        """
        versions = self.versions()
        if pinned is not None:
            began = F.create_map(*[F.lit(x) for pair in pinned.items() for x in pair]) if pinned else F.create_map().cast("map<string,int>")
            versions = versions.where(F.col("apply_on_update") | (F.col("version") <= F.coalesce(began[F.col("rule_id")], F.lit(0))))
        chosen = versions.groupBy("rule_id").agg(F.max_by(F.struct(*_NAMES[1:]), "version").alias("r")).select("rule_id", "r.*")
        return [BookRule.of(r) for r in chosen.orderBy("rule_id").limit(MOST_RULES).collect()]


def watch(
    events: DataFrame,
    book: RuleBook,
    out: str,
    checkpoint: str,
    keep: Sequence[str | Column] = (),
    event: str = "event",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Alert rows of a stream of events, by the rules that hold when each batch begins (STM6).

    The book is read anew by every batch. Alerts go to `out`, a partition for each batch, with the
    rule's version. The rules of a batch are stored before its alerts are written, so a batch that
    is repeated after a failure applies the same versions, whatever was published since.
    """
    spark, pinned = book.spark, book.newest()
    stream = md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def rules_of(batch_id: int) -> list[BookRule]:
        used = RuleBook(spark, f"{out}/rules/{stream}/{batch_id}")
        if used.stored() is None:
            rows = [r.row() for r in book.holding(pinned)]
            spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("overwrite").parquet(used.path)
        return used.holding()

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = {f"{r.rule_id}:{r.version}": r.alert_rule(event) for r in rules_of(batch_id)}
        fired = alerts_of(batch, rules, keep)
        split = F.split("rule_id", ":(?=[0-9]+$)")
        named = fired.withColumns({"rule_id": split[0], "version": split[1].cast("int")})
        named.write.mode("overwrite").parquet(f"{out}/alerts/ingest__stream=s{stream}/ingest__batch={batch_id}")

    writer = events.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """Alerts of all batches written by `watch`."""
    return spark.read.parquet(f"{out}/alerts").drop("ingest__stream", "ingest__batch")
