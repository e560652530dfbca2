from veleta.streaming.alerts import AlertRule, alerts
from veleta.streaming.events import PathRule, alerts_of, as_events, event_fields, observed_schema, stream_events
from veleta.streaming.ingest import (
    SENSOR_COLUMNS, SENSOR_SCHEMA, append_merging, append_stream, ingest_messages, read_merged, stamp, stream_json,
)
from veleta.streaming.newest import keep_newest
from veleta.streaming.progress import ProgressLog, progress_frame, read_progress, status_of
from veleta.streaming.rulebook import BookRule, RuleBook, read_alerts, watch

__all__ = [
    "AlertRule", "BookRule", "PathRule", "ProgressLog", "RuleBook", "SENSOR_COLUMNS", "SENSOR_SCHEMA", "alerts",
    "alerts_of", "append_merging", "append_stream", "as_events", "event_fields", "ingest_messages", "keep_newest",
    "observed_schema", "progress_frame", "read_alerts", "read_merged", "read_progress", "stamp", "status_of",
    "stream_events", "stream_json", "watch",
]
