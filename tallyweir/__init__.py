"""Access-log metrics on Spark: lines in, per-bucket traffic and upstream metrics out."""

from tallyweir.operators.metrics import METRICS, metric, metrics_wide
from tallyweir.operators.partials import line_counts, partial_metrics, skip_counts
from tallyweir.operators.points import points_from_partials, static_tags, tagged_to_lines, to_lines, with_tags
from tallyweir.operators.requests import accepted, parse_lines, rejected
from tallyweir.options import OptionMismatch, RunOptions, StateMismatch
from tallyweir.session import tune
from tallyweir.sources.follow import LogFiles
from tallyweir.sources.ledger import SendOnce
from tallyweir.sources.logs import cap_lines, read_log, stream_log
from tallyweir.sources.scratch import written
from tallyweir.streaming.per_source import counted_by_source, skipped_by_source, start_by_source
from tallyweir.streaming.runs import MetricsRuns, stream_runs
from tallyweir.streaming.watermarked import closed_bucket_points, start_closed_buckets

__all__ = [
    "METRICS",
    "LogFiles",
    "MetricsRuns",
    "OptionMismatch",
    "RunOptions",
    "SendOnce",
    "StateMismatch",
    "accepted",
    "cap_lines",
    "closed_bucket_points",
    "counted_by_source",
    "line_counts",
    "metric",
    "metrics_wide",
    "parse_lines",
    "partial_metrics",
    "points_from_partials",
    "read_log",
    "rejected",
    "skip_counts",
    "skipped_by_source",
    "start_by_source",
    "start_closed_buckets",
    "static_tags",
    "stream_log",
    "stream_runs",
    "tagged_to_lines",
    "to_lines",
    "tune",
    "with_tags",
    "written",
]
