"""Alert rows out of events (STM5-6, FLT6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlertRule:
    """What fires, what the message says and who receives it.

    `condition` None fires on every event. A rule that is not enabled fires on none. Rules that
    change while a stream runs are kept in a `RuleBook`.
    """

    subject: str
    headline: str
    sent_to: Sequence[str]
    copy_to: Sequence[str] = ()
    blind_copy_to: Sequence[str] = ()
    message: str = ""
    extra: Mapping[str, Column] = field(default_factory=dict)
    locale: str = "en-us"
    condition: Column | None = None
    enabled: bool = False


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def alert_struct(rule: AlertRule) -> list[Column]:
    """Columns of an alert."""
    extra = F.array(*[F.concat(F.lit(f"{n}: "), c.cast("string")) for n, c in rule.extra.items()])
    return [
        F.lit(rule.subject).alias("subject"),
        F.lit(rule.headline).alias("headline"),
        _texts(rule.sent_to).alias("sent_to"),
        _texts(rule.copy_to).alias("copy_to"),
        _texts(rule.blind_copy_to).alias("blind_copy_to"),
        F.lit(rule.message).alias("message"),
        extra.cast("array<string>").alias("extra"),
        F.lit(rule.locale).alias("locale"),
    ]


def alerts(events: DataFrame, rule: AlertRule, keep: Sequence[str] = ()) -> DataFrame:
    """One alert per firing event; works on streams and tables alike."""
    fires = rule.condition if rule.condition is not None else F.lit(True)
    fired = events.where(fires if rule.enabled else F.lit(False))
    return fired.select(*keep, *alert_struct(rule))
