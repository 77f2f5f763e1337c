"""Statistics of a run as one more point."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyweir.operators.points import NO_TAGS, rows_to_lines

MEASUREMENT = "run_stats"
# The fields of the statistics point.
STATS_FIELDS = (
    "duration_seconds",
    "parsed_lines",
    "parse_duration_seconds",
    "skipped_lines",
    "mean_time_per_line_seconds",
    "sent_points",
    "resent_points",
)
STATS_SCHEMA = (
    "run_id bigint, epoch double, duration_seconds double, parsed_lines bigint, parse_duration_seconds double, "
    "skipped_lines bigint, mean_time_per_line_seconds double, sent_points bigint, resent_points bigint"
)


@dataclass(frozen=True)
class RunStats:
    run_id: int
    epoch: float
    duration_seconds: float
    parsed_lines: int
    parse_duration_seconds: float
    skipped_lines: int
    mean_time_per_line_seconds: float
    sent_points: int
    resent_points: int

    @classmethod
    def measured(
        cls, run_id: int, epoch: float, duration: float, parse_duration: float, parsed: int, skipped: int,
        sent: int, resent: int,
    ) -> RunStats:
        """Durations to a tenth of a second; no parse time is shown for a run without lines."""
        parse = round(parse_duration, 1) if parsed else 0.0
        per_line = parse / parsed if parsed else 0.0
        return cls(run_id, epoch, round(duration, 1), parsed, parse, skipped, per_line, sent, resent)


def stats_frame(spark: SparkSession, stats: RunStats) -> DataFrame:
    return spark.createDataFrame([asdict(stats)], STATS_SCHEMA)


def stats_lines(stats: DataFrame, tags: str = NO_TAGS, precision: str = "m") -> DataFrame:
    """The statistics rendered as text in ``line``."""
    present = [f for f in STATS_FIELDS if f in stats.columns]
    return rows_to_lines(stats, MEASUREMENT, present, tags, "epoch", precision)
