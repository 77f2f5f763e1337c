"""Incremental runs with durable state, callable in batch or from a stream.

State lives in one folder in two slots.  A run writes its partials, marks and read positions into the slot
that the last commit does not use and commits by writing one small file there, so a run that dies half-way
changes nothing and is repeated under the same number.  Points are delivered before the commit: they may be
sent again, but are never lost.  Starting over begins a new epoch in the same folder; run numbers, points and
rejects belong to an epoch.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tallyweir.operators.increment import (
    MARKS_SCHEMA,
    advance_marks,
    baseline_marks,
    closed_partials,
    label_skips,
    marks_from_times,
    open_partials,
)
from tallyweir.operators.partials import SKIP, SUMS, WIDE, WIDE_SUMS, add_up, contributions, contributions_of, line_counts, with_source
from tallyweir.operators.points import POINT_SCHEMA, points_from_partials
from tallyweir.operators.requests import REASONS_BEFORE_LATE, parse_lines
from tallyweir.operators.runstats import RunStats, stats_frame
from tallyweir.options import RunOptions, StateMismatch
from tallyweir.sources.follow import FILES_SCHEMA, LogFiles, follow
from tallyweir.sources.logs import POSITIONS_SCHEMA, advanced, has_place, next_blocks, take_blocks
from tallyweir.sources.points_table import PointsTable
from tallyweir.sources.sinks import write_points

log = logging.getLogger(__name__)

COMMIT_SCHEMA = (
    "epoch bigint, run_id bigint, slot int, bucket_duration int, lookback_factor int, weighting string, "
    "checkpoint string, undelivered array<string>"
)
REPEATED = 10_000
REJECTS_SCHEMA = "source string, value string, reason string, run bigint"
PARTIALS_SCHEMA = (
    "source string, kind string, bucket bigint, vhost string, protocol string, loctag string, upstream string, "
    "status string, lines bigint, " + ", ".join(f"{name} {WIDE if name in WIDE_SUMS else 'bigint'}" for name in SUMS) + ", last_msec double"
)
# Gets the points of one delivery; raising means that they were not delivered.
PointSink = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Commit:
    """``undelivered`` holds the folders of points that are still to be sent, ``checkpoint`` the stream's mark."""

    epoch: int
    run_id: int
    slot: int
    bucket_duration: int
    lookback_factor: int
    weighting: str
    checkpoint: str | None
    undelivered: list[str]


class MetricsRuns:
    """Successive runs over the new lines of the same logs."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        options: RunOptions | None = None,
        sink: PointSink | None = None,
        start_over: bool = False,
        stats_sink: PointSink | None = None,
    ) -> None:
        """Without a ``sink`` runs are dry: points are kept in the folder and the state moves on.

        ``stats_sink`` gets the statistics of each run as a frame of one row.
        """
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.options = options or RunOptions()
        self.sink = sink
        self.stats_sink = stats_sink
        self.published = PointsTable(spark, f"{self.folder}/points")
        self.checkpoint: str | None = None
        newest = self._newest_commit()
        self.epoch = 0 if newest is None else newest.epoch + start_over

    # -- state ---------------------------------------------------------------

    def last_commit(self) -> Commit | None:
        newest = self._newest_commit()
        return newest if newest is not None and newest.epoch == self.epoch else None

    def _newest_commit(self) -> Commit | None:
        # at most two files of one row each
        try:
            rows = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.folder}/slot*/commit").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        newest = max(rows, key=lambda r: (r["epoch"], r["run_id"]), default=None)
        return None if newest is None else Commit(**newest.asDict())

    def pair_with(self, checkpoint: str) -> None:
        """Tie the state to a stream's checkpoint by a mark in both; refuse one that belongs to another state."""
        path = f"{checkpoint.rstrip('/')}/state-mark"
        last = self.last_commit()
        try:
            mark = self.spark.read.text(path).head()["value"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if last is not None:
                raise StateMismatch(
                    f"{self.folder} has committed runs, but {checkpoint} is new: its run numbers would begin again; "
                    "use the old checkpoint or start over"
                ) from None
            mark = uuid.uuid4().hex
            self.spark.createDataFrame([(mark,)], "value string").coalesce(1).write.text(path)
        if last is not None and last.checkpoint != mark:
            raise StateMismatch(f"{checkpoint} belongs to another state than {self.folder}; start over to use it")
        self.checkpoint = mark

    def partials(self, slot: int) -> DataFrame:
        return self.spark.read.schema(PARTIALS_SCHEMA).parquet(f"{self.folder}/slot{slot}/partials")

    def marks(self, slot: int) -> DataFrame:
        return self.spark.read.schema(MARKS_SCHEMA).parquet(f"{self.folder}/slot{slot}/marks")

    def leftover(self) -> DataFrame:
        """Partials of the buckets still open after the last run."""
        last = self.last_commit()
        if last is None:
            return self.spark.createDataFrame([], PARTIALS_SCHEMA)
        return open_partials(self.partials(last.slot), self.marks(last.slot))

    def positions(self, slot: int) -> DataFrame:
        return self.spark.read.schema(POSITIONS_SCHEMA).parquet(f"{self.folder}/slot{slot}/positions")

    def files(self, slot: int) -> DataFrame:
        """The followed files after the run of the slot."""
        return self.spark.read.schema(FILES_SCHEMA).parquet(f"{self.folder}/slot{slot}/files")

    def points(self, *run_ids: int) -> DataFrame:
        """Published points of the given runs of this epoch, or of all of them."""
        through = self.published.through(self.epoch)
        if run_ids and min(run_ids) > through:
            return self._points_in([f"state={self.epoch}/run={i}" for i in run_ids])
        points = self.published.read(self.epoch)
        return points.where(F.col("run").isin(list(run_ids))) if run_ids else points

    def points_between(self, since: int, until: int) -> DataFrame:
        """Published points of this epoch from one second on and before another; only their days are opened."""
        return self.published.read(self.epoch, since, until)

    def merge_points(self) -> None:
        """Merge the points of finished runs into few files per day.  Runs that are still owed stay as they are."""
        last = self.last_commit()
        if last is None:
            return
        owed = [int(name.split("run=")[1]) for name in last.undelivered if name.startswith(f"state={self.epoch}/")]
        through = min([last.run_id, *(i - 1 for i in owed)])
        if through > self.published.through(self.epoch):
            self.published.merge(self.epoch, through)

    def _points_in(self, folders: list[str]) -> DataFrame:
        # only these folders are listed, however many runs there have been
        root = f"{self.folder}/points"
        reader = self.spark.read.schema(f"{POINT_SCHEMA}, state bigint, run bigint").option("basePath", root)
        return reader.parquet(*[f"{root}/{name}" for name in folders]).drop("state")

    def rejects(self, *run_ids: int) -> DataFrame:
        """Rejected lines of the given runs of this epoch, or of all, if the options keep them."""
        root = f"{self.folder}/rejects"
        folders = [f"state={self.epoch}/run={i}" for i in run_ids] or [f"state={self.epoch}"]
        reader = self.spark.read.schema(REJECTS_SCHEMA).option("basePath", f"{root}/state={self.epoch}")
        return reader.parquet(*[f"{root}/{name}" for name in folders])

    # -- runs ----------------------------------------------------------------

    def run(self, lines: DataFrame | LogFiles, run_id: int | None = None, now: float | None = None) -> RunStats | None:
        """Process new lines; None if the run of this number is already committed.

        Log files are followed: each run opens those that changed and goes on after the last line done, also after
        a rotation.  Of lines with a place, as ``read_log`` gives it, those after the last run's are taken, by path.
        All other lines are new ones.  ``now`` is the clock that ``max_ahead`` refers to.
        """
        started = time.time()
        options, last, newest = self.options, self.last_commit(), self._newest_commit()
        if run_id is None:
            run_id = 0 if last is None else last.run_id + 1
        elif last is not None and run_id <= last.run_id:
            return None
        if last is not None:
            self._check_options(last)
        # the slot of the newest commit stays untouched until this run commits
        slot = 0 if newest is None else 1 - newest.slot

        lines = self._next_lines(lines, slot, last)
        before = self._marks_before(last)
        horizon = options.last_bucket(started if now is None else now)
        parsed, skipped = self._aggregate(lines, slot, last, before, horizon)
        if options.keep_rejects:
            self._write_rejects(slot, run_id)
        parse_duration = time.time() - started

        closed = closed_partials(self.partials(slot), self.marks(slot))
        points = points_from_partials(closed, options.bucket_duration)
        write_points(points, f"{self.folder}/points/state={self.epoch}/run={run_id}")

        # what an earlier epoch could not deliver is still owed
        undelivered = [] if newest is None else list(newest.undelivered)
        sent, resent, undelivered = self._deliver(f"state={self.epoch}/run={run_id}", undelivered)
        self._commit(
            Commit(
                self.epoch, run_id, slot, options.bucket_duration, options.lookback_factor, options.weighting,
                self.checkpoint, undelivered,
            )
        )
        stats = RunStats.measured(
            run_id, time.time(), time.time() - started, parse_duration, parsed, skipped, sent, resent
        )
        if self.stats_sink is not None:
            self._send(stats_frame(self.spark, stats), self.stats_sink)
        return stats

    def _check_options(self, last: Commit) -> None:
        mine = (self.options.bucket_duration, self.options.lookback_factor, self.options.weighting)
        theirs = (last.bucket_duration, last.lookback_factor, last.weighting)
        if mine != theirs and not self.leftover().isEmpty():
            self.options.check_against(*theirs)

    def _next_lines(self, lines: DataFrame | LogFiles, slot: int, last: Commit | None) -> DataFrame:
        """The lines after the last run's, if their files or places are known; where they end goes into the slot."""
        path = f"{self.folder}/slot{slot}"
        files = self.spark.createDataFrame([], FILES_SCHEMA) if last is None else self.files(last.slot)
        before = self.spark.createDataFrame([], POSITIONS_SCHEMA) if last is None else self.positions(last.slot)
        if isinstance(lines, LogFiles):
            before.write.mode("overwrite").parquet(f"{path}/positions")
            return with_source(follow(self.spark, lines, files, path, self.options.max_lines))
        files.write.mode("overwrite").parquet(f"{path}/files")
        lines = with_source(lines)
        if not has_place(lines):
            if self.options.max_lines:
                raise ValueError("a cap needs the place of each line, as read_log gives it")
            before.write.mode("overwrite").parquet(f"{path}/positions")
            return lines
        next_blocks(lines, self.options.max_lines, before).write.mode("overwrite").parquet(f"{path}/blocks")
        blocks = self.spark.read.parquet(f"{path}/blocks")
        advanced(before, blocks).write.mode("overwrite").parquet(f"{path}/positions")
        return take_blocks(lines, blocks)

    def _marks_before(self, last: Commit | None) -> DataFrame:
        if last is None:
            return self.spark.createDataFrame([], MARKS_SCHEMA)
        # closed_through is in buckets of the last run's width, which may differ if none is open
        return marks_from_times(self.marks(last.slot), self.options.bucket_duration, self.options.lookback_factor)

    def _aggregate(
        self, lines: DataFrame, slot: int, last: Commit | None, before: DataFrame, horizon: int | None
    ) -> tuple[int, int]:
        options = self.options
        if options.keep_rejects:
            rows = contributions_of(self._judged(lines, before, horizon), options.weighting, line="_line")
        else:
            rows = contributions(lines, options.bucket_duration, options.weighting)
        carried = rows if last is None else rows.unionByName(self.leftover(), allowMissingColumns=True)
        added = add_up(carried, *(["line"] if options.keep_rejects else []))
        self._write_partials(label_skips(added, before, horizon, options.skip_to_end), slot)
        partials = self.partials(slot)
        noted = baseline_marks(partials, options.bucket_duration, options.lookback_factor)
        known = before.unionByName(noted.select(*before.columns))
        marks = advance_marks(known, partials, options.bucket_duration, options.lookback_factor)
        marks.write.mode("overwrite").parquet(f"{self.folder}/slot{slot}/marks")
        counts = line_counts(partials).agg(F.sum("parsed_lines"), F.sum("skipped_lines")).head()
        return counts[0] or 0, counts[1] or 0

    def _judged(self, lines: DataFrame, before: DataFrame, horizon: int | None) -> DataFrame:
        """Parsed lines with the reason that marks and clock give them, and as ``_line`` the text of those to keep.

        Those of a source that is only noted are not kept one by one; the added-up rows tell what becomes of them.
        """
        parsed = parse_lines(lines, self.options.bucket_duration)
        # the marks go to the lines: a join by source would bring all lines of a source to one task
        known = F.broadcast(before.selectExpr("source", "closed_through AS _closed", "true AS _known"))
        unreadable = ", ".join(f"'{r}'" for r in REASONS_BEFORE_LATE)
        noted = f"_known IS NULL AND {self.options.skip_to_end}"
        reason = (
            f"CASE WHEN reason IN ({unreadable}) OR {noted} THEN reason "
            f"WHEN bucket > {horizon if horizon is not None else 'NULL'} THEN 'future' "
            "WHEN bucket <= _closed THEN 'late' ELSE reason END"
        )
        others = [c for c in parsed.columns if c != "reason"]
        return parsed.join(known, "source", "left").selectExpr(*others, f"{reason} AS reason", f"CASE WHEN NOT ({noted}) THEN value END AS _line")

    def _write_rejects(self, slot: int, run_id: int) -> None:
        """The rejected lines themselves, which the partials of the run hold once with their number."""
        partials = self.spark.read.schema(f"{PARTIALS_SCHEMA}, line string").parquet(f"{self.folder}/slot{slot}/partials")
        listed = partials.where(f"kind = '{SKIP}' AND line IS NOT NULL").selectExpr("source", "line AS value", "status AS reason", "lines")
        # a line that was repeated very often is not made an array of that length
        many = listed.selectExpr("*", f"explode(sequence(0L, lines - 1, {REPEATED}L)) AS _first")
        once = many.selectExpr("source", "value", "reason", f"explode(array_repeat(0, int(least({REPEATED}L, lines - _first)))) AS _n")
        once.drop("_n").write.mode("overwrite").parquet(f"{self.folder}/rejects/state={self.epoch}/run={run_id}")

    def _write_partials(self, partials: DataFrame, slot: int) -> None:
        partials.write.mode("overwrite").parquet(f"{self.folder}/slot{slot}/partials")

    def _deliver(self, own: str, undelivered: list[str]) -> tuple[int, int, list[str]]:
        """Saved points first, then the new ones; a failed send is kept whole for a later run."""
        sent = resent = 0
        if undelivered:
            saved = self._points_in(undelivered)
            if self._send(saved, self.sink):
                resent = saved.count()
                # a dry run sends nothing, so the saved points stay saved
                undelivered = undelivered if self.sink is None else []
        new = self._points_in([own])
        count = new.count()
        if count and self._send(new, self.sink):
            sent = count
        elif count:
            undelivered = [*undelivered, own]
            limit = self.options.outbox_limit
            if limit is not None and len(undelivered) > limit:
                dropped = undelivered[: len(undelivered) - limit]
                log.warning("outbox is full, %d sends will not be delivered: %s", len(dropped), ", ".join(dropped))
                undelivered = undelivered[len(dropped) :]
        return sent, resent, undelivered

    def _send(self, frame: DataFrame, sink: PointSink | None) -> bool:
        if sink is None:
            return True
        try:
            sink(frame)
        except Exception as error:  # whatever the caller's sink raises, the points stay
            log.warning("not delivered: %s", error)
            return False
        return True

    def _commit(self, commit: Commit) -> None:
        row = Row(**vars(commit))
        frame = self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1)
        frame.write.mode("overwrite").json(f"{self.folder}/slot{commit.slot}/commit")


def stream_runs(
    lines: DataFrame, runs: MetricsRuns, checkpoint: str, every: str | None = None
):
    """Start a stream whose micro-batches are runs; each file is read once, each run committed once.

    Without ``every`` (``"60 seconds"``) the stream takes what is there and ends.  State and checkpoint belong
    together; either of them with another partner is refused.
    """
    runs.pair_with(checkpoint)

    def one_run(batch: DataFrame, batch_id: int) -> None:
        runs.run(batch, run_id=batch_id)

    writer = lines.writeStream.foreachBatch(one_run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
