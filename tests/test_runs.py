from __future__ import annotations

import random

import pytest
from samples import bare_line, line
from test_metrics import random_lines

from tallyweir import MetricsRuns, OptionMismatch, RunOptions, StateMismatch, read_log, stream_log, stream_runs
from tallyweir.operators.increment import baseline
from tallyweir.operators.points import POINT_COLUMNS
from tallyweir.streaming.watermarked import closed_bucket_points, start_closed_buckets

OPTIONS = RunOptions(bucket_duration=60, lookback_factor=2, skip_to_end=False)


class Store:
    """Collects delivered points, or fails."""

    def __init__(self):
        self.broken = False
        self.sends = []

    def __call__(self, points):
        if self.broken:
            raise OSError("store is away")
        self.sends.append(sorted((r.run, r.measurement, r.bucket) for r in points.collect()))


def at(*minutes, **changed):
    return [bare_line(60.0 * m - 30, **changed) for m in minutes]


def hits(runs, *ids):
    return sorted((r.bucket, r.value_i) for r in runs.points(*ids).where("measurement = 'hits'").collect())


def point_set(points):
    rows = points.select(*POINT_COLUMNS).collect()
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "state")


def test_closing_and_leftovers(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, OPTIONS)
    stats = runs.run(lines_of(*at(1, 2, 2, 3, 4), "broken"))
    assert (stats.parsed_lines, stats.skipped_lines) == (6, 1)
    assert hits(runs) == [(1, 1), (2, 2)]
    assert sorted((r.bucket, r.hits) for r in runs.leftover().collect()) == [(3, 1), (4, 1)]
    # bucket 3 is completed by the second run; bucket 1 and 2 are closed, so their lines are late
    stats = runs.run(lines_of(*at(3, 5, 1, 2), bare_line("15", status="x"), bare_line("x", status="x")))
    assert (stats.parsed_lines, stats.skipped_lines) == (6, 4)
    assert hits(runs, 1) == [(3, 2)]
    last = runs.last_commit()
    reasons = runs.partials(last.slot).where("kind = 'skip'").groupBy("status").sum("lines").collect()
    # lateness is checked before the status of a line, but after its time
    assert {r.status: r["sum(lines)"] for r in reasons} == {"late": 3, "bad_msec": 1}


def test_a_gap_loses_nothing(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, OPTIONS)
    runs.run(lines_of(*at(1, 2, 3)))
    runs.run(lines_of(*at(10)))
    assert hits(runs) == [(1, 1), (2, 1), (3, 1)]


def test_the_mark_never_moves_back(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, OPTIONS)
    runs.run(lines_of(*at(10)))
    empty = runs.run(lines_of("").limit(0))
    assert (empty.parsed_lines, empty.mean_time_per_line_seconds) == (0, 0.0)
    stats = runs.run(lines_of(*at(8, 9)))
    assert stats.skipped_lines == 1
    assert hits(runs) == []
    assert sorted(r.bucket for r in runs.leftover().collect()) == [9, 10]


def test_each_source_has_its_own_mark(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, OPTIONS)
    runs.run(lines_of(*[("fast", t) for t in at(20)], *[("slow", t) for t in at(1)]))
    runs.run(lines_of(*[("fast", t) for t in at(2)], *[("slow", t) for t in at(2, 3)]))
    published = runs.points().where("measurement = 'hits'").collect()
    assert [(r.source, r.bucket) for r in published] == [("slow", 1)]


def test_first_run_notes_the_end(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, RunOptions(bucket_duration=60))
    stats = runs.run(lines_of(*at(3, 5, 4), "7|junk", line(version="2", msec="10")))
    assert (stats.parsed_lines, stats.skipped_lines, stats.sent_points) == (5, 5, 0)
    # lines up to the end of bucket 5 are taken as old, whole buckets follow
    stats = runs.run(lines_of(bare_line("300"), *at(6, 7, 8)))
    assert stats.skipped_lines == 1
    assert hits(runs) == [(6, 1)]


def test_baseline_of_a_source_without_times(lines_of):
    rows = {r.source: r for r in baseline(lines_of(("a", "junk"), ("b", bare_line("61"))), 60, 2).collect()}
    assert (rows["a"].bucket, rows["a"].last_msec, rows["a"].lines) == (0, 120.0, 1)
    assert (rows["b"].bucket, rows["b"].last_msec) == (2, 240.0)


def test_options_may_not_change_under_open_buckets(spark, lines_of, folder):
    MetricsRuns(spark, folder, OPTIONS).run(lines_of(*at(1, 2)))
    for changed in (
        RunOptions(bucket_duration=30, skip_to_end=False),
        RunOptions(bucket_duration=60, lookback_factor=3, skip_to_end=False),
        RunOptions(bucket_duration=60, weighting="per_contact", skip_to_end=False),
    ):
        with pytest.raises(OptionMismatch):
            MetricsRuns(spark, folder, changed).run(lines_of(*at(3)))
    again = MetricsRuns(spark, folder, RunOptions(bucket_duration=30, skip_to_end=False), start_over=True)
    assert again.run(lines_of(*at(3))).run_id == 0
    assert {r.bucket for r in again.leftover().collect()} == {5}


def test_options_may_change_when_nothing_is_open(spark, lines_of, folder):
    MetricsRuns(spark, folder, RunOptions(bucket_duration=60)).run(lines_of(*at(10)))
    runs = MetricsRuns(spark, folder, RunOptions(bucket_duration=30, lookback_factor=1))
    stats = runs.run(lines_of(bare_line("599"), bare_line("800")))
    assert stats.skipped_lines == 1


def test_failed_sends_are_kept_and_replayed(spark, lines_of, folder):
    store = Store()
    runs = MetricsRuns(spark, folder, RunOptions(skip_to_end=False, lookback_factor=0, outbox_limit=2), store)
    store.broken = True
    for minute in (1, 2, 3):
        assert runs.run(lines_of(*at(minute))).sent_points == 0
    assert runs.last_commit().undelivered == ["state=0/run=1", "state=0/run=2"]
    store.broken = False
    stats = runs.run(lines_of(*at(4)))
    assert stats.sent_points > 0 and stats.resent_points == 2 * stats.sent_points
    assert [sorted({p[0] for p in send}) for send in store.sends] == [[1, 2], [3]]
    assert runs.last_commit().undelivered == []


def test_no_outbox(spark, lines_of, folder):
    store = Store()
    store.broken = True
    runs = MetricsRuns(spark, folder, RunOptions(skip_to_end=False, lookback_factor=0, outbox_limit=0), store)
    runs.run(lines_of(*at(1)))
    assert runs.last_commit().undelivered == []


def test_a_dry_run_moves_the_state_on(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, OPTIONS)
    stats = runs.run(lines_of(*at(1, 2, 3)))
    assert stats.sent_points == runs.points(0).count() > 0
    assert runs.last_commit().run_id == 0


def test_a_run_that_died_is_repeated(spark, lines_of, folder, monkeypatch):
    runs = MetricsRuns(spark, folder, OPTIONS)
    runs.run(lines_of(*at(1, 2)))
    monkeypatch.setattr(runs, "_commit", lambda commit: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run(lines_of(*at(3, 4)))
    monkeypatch.undo()
    runs = MetricsRuns(spark, folder, OPTIONS)
    assert runs.run(lines_of(*at(3, 4))).run_id == 1
    assert hits(runs) == [(1, 1), (2, 1)]
    # a committed run of the same number is not done again
    assert runs.run(lines_of(*at(3, 4)), run_id=1) is None


def test_capped_runs_read_each_line_once(spark, tmp_path, folder):
    log = tmp_path / "logs" / "access.log"
    log.parent.mkdir()
    text = at(*range(3, 11))
    log.write_text("\n".join(text) + "\n")
    old = tmp_path / "logs" / "access.log.2"
    older = tmp_path / "logs" / "access.log.10"
    old.write_text("\n".join(at(2, 2)) + "\n")
    older.write_text("\n".join(at(1)) + "\n")
    runs = MetricsRuns(spark, folder, RunOptions(skip_to_end=False, max_lines=5))
    read = lambda: read_log(spark, str(log.parent), r"/(access)[^/]*$", r"\.log\.(\d+)$")
    assert runs.run(read()).parsed_lines == 5
    # the oldest file first, so nothing is late: buckets 1 and 2 close when the line of bucket 4 is read
    assert hits(runs) == [(1, 1), (2, 2)]
    log.write_text("\n".join([*text, *at(11)]) + "\n")  # it has grown meanwhile
    assert [runs.run(read()).parsed_lines for _ in range(3)] == [5, 2, 0]
    one = MetricsRuns(spark, str(tmp_path / "one"), RunOptions(skip_to_end=False))
    assert one.run(read()).parsed_lines == 12 and hits(one) == hits(runs)
    assert one.run(read()).parsed_lines == 0
    with pytest.raises(ValueError):
        runs.run(spark.createDataFrame([("1|1",)], "value string"))


def test_lines_without_source_are_kept(spark, folder):
    lines = spark.createDataFrame([(None, t) for t in at(1, 2)] + [("a", t) for t in at(1, 5)] + [(None, "x")], "source string, value string")
    runs = MetricsRuns(spark, folder, RunOptions(skip_to_end=False, lookback_factor=0))
    stats = runs.run(lines)
    published = runs.points().where("measurement = 'hits'").agg({"value_i": "sum"}).first()[0]
    assert published + stats.skipped_lines == stats.parsed_lines == 5


def test_a_source_met_late_is_only_noted(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, RunOptions(bucket_duration=60, lookback_factor=0))
    runs.run(lines_of(*[("a", t) for t in at(1)]))
    stats = runs.run(lines_of(*[("a", t) for t in at(2)], *[("b", t) for t in at(1, 2)], ("b", "x")))
    assert stats.skipped_lines == 3
    runs.run(lines_of(*[("b", t) for t in at(2, 3)]))
    published = runs.points().where("measurement = 'hits'").collect()
    assert sorted((r.source, r.bucket) for r in published) == [("a", 2), ("b", 3)]


def test_a_clock_ahead_costs_only_its_line(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, RunOptions(skip_to_end=False, lookback_factor=0, max_ahead=3600))
    assert runs.run(lines_of(*at(1, 2), bare_line("250000000000")), now=600.0).skipped_lines == 1
    assert runs.run(lines_of(*at(3, 4)), now=700.0).skipped_lines == 0
    assert hits(runs) == [(b, 1) for b in (1, 2, 3, 4)]


def test_rejects_and_statistics_of_a_run(spark, lines_of, folder):
    seen = []
    options = RunOptions(skip_to_end=False, lookback_factor=0, keep_rejects=True)
    runs = MetricsRuns(spark, folder, options, stats_sink=lambda stats: seen.append(stats.first()))
    runs.run(lines_of(*at(5), "junk"))
    runs.run(lines_of(*at(4, 6), line(status="x", msec="599")))
    got = sorted((r.run, r.reason) for r in runs.rejects().collect())
    assert got == [(0, "bad_version"), (1, "bad_status"), (1, "late")]
    assert [(s.run_id, s.parsed_lines, s.skipped_lines) for s in seen] == [(0, 2, 1), (1, 3, 2)]


def test_lines_of_one_source_are_not_dealt_by_source(spark, lines_of, folder, monkeypatch):
    plans, write = [], MetricsRuns._write_partials
    monkeypatch.setattr(MetricsRuns, "_write_partials", lambda self, partials, slot: plans.append(partials) or write(self, partials, slot))
    runs = MetricsRuns(spark, folder, RunOptions(bucket_duration=60, lookback_factor=1, skip_to_end=False, keep_rejects=True))
    runs.run(lines_of(*[("one", line) for line in at(1, 2, 3)]))
    assert "SortMergeJoin" not in plans[0]._jdf.queryExecution().sparkPlan().toString()


def test_start_over_is_a_new_epoch(spark, lines_of, folder):
    store = Store()
    first = MetricsRuns(spark, folder, OPTIONS, store)
    store.broken = True
    first.run(lines_of(*at(1, 2, 3)))
    store.broken = False
    again = MetricsRuns(spark, folder, OPTIONS, store, start_over=True)
    for i, minutes in enumerate(((11, 12), (13,), (14,))):
        assert again.run(lines_of(*at(*minutes)), run_id=i).run_id == i
    assert hits(again) == [(11, 1), (12, 1)]
    # what the first epoch owed is sent by the second
    assert {p[2] for p in store.sends[0]} == {1}
    assert MetricsRuns(spark, folder, OPTIONS).last_commit().run_id == 2


def test_state_and_checkpoint_belong_together(spark, tmp_path, folder):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "1.log").write_text("\n".join(at(1, 2, 3)) + "\n")

    def go(checkpoint, state=folder, **kw):
        runs = MetricsRuns(spark, state, OPTIONS, **kw)
        stream_runs(stream_log(spark, str(logs), "(never)"), runs, str(tmp_path / checkpoint)).awaitTermination()
        return runs

    go("cp1")
    with pytest.raises(StateMismatch):
        go("cp2")
    go("cp3", state=str(tmp_path / "other"))
    with pytest.raises(StateMismatch):
        go("cp3")
    assert hits(go("cp2", start_over=True)) == [(1, 1)]
    assert hits(go("cp2")) == [(1, 1)]


def test_a_run_lists_only_its_own_points(spark, lines_of, folder):
    runs = MetricsRuns(spark, folder, RunOptions(skip_to_end=False, lookback_factor=0))
    for minute in range(4):
        runs.run(lines_of(*at(minute)))
    assert all("/state=0/run=2/" in f for f in runs.points(2).inputFiles())


def ordered_lines(seed, n=240):
    lines = [text for text in random_lines(seed, n)]
    return sorted(lines, key=lambda text: float(text.split("|")[1]))


@pytest.mark.parametrize("cuts", [[80, 160], [1, 2, 200]])
def test_many_runs_equal_one(spark, lines_of, tmp_path, cuts):
    lines = ordered_lines(6)
    # unordered inside the lookback of two buckets
    for i in range(0, len(lines) - 10, 10):
        part = lines[i : i + 10]
        random.Random(i).shuffle(part)
        lines[i : i + 10] = part
    one = MetricsRuns(spark, str(tmp_path / "one"), OPTIONS)
    one.run(lines_of(*lines))
    many = MetricsRuns(spark, str(tmp_path / "many"), OPTIONS)
    edges = [0, *cuts, len(lines)]
    skipped = [many.run(lines_of(*lines[a:b])).skipped_lines for a, b in zip(edges, edges[1:])]
    gzip_free = "measurement <> 'gzip_count'"  # its zero rows depend on what else a run has
    assert point_set(many.points().where(gzip_free)) == point_set(one.points().where(gzip_free))
    assert sum(skipped) == sum(text.split("|")[5] == "x" for text in lines)


def test_streamed_runs_equal_batch(spark, lines_of, tmp_path):
    lines = ordered_lines(7)
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "1.log").write_text("\n".join(lines[:100]) + "\n")
    runs = MetricsRuns(spark, str(tmp_path / "streamed"), OPTIONS)

    def go():
        stream_runs(stream_log(spark, str(logs), "(never)"), runs, str(tmp_path / "cp")).awaitTermination()

    go()
    first = runs.last_commit().run_id
    (logs / "2.log").write_text("\n".join(lines[100:]) + "\n")
    go()
    go()
    assert (first, runs.last_commit().run_id) == (0, 1)
    whole = MetricsRuns(spark, str(tmp_path / "whole"), OPTIONS)
    whole.run(lines_of(*lines))
    gzip_free = "measurement <> 'gzip_count'"
    assert point_set(runs.points().where(gzip_free)) == point_set(whole.points().where(gzip_free))


def test_watermark_closes_the_same_buckets(spark, lines_of, tmp_path):
    lines = ordered_lines(8)
    logs = tmp_path / "logs"
    logs.mkdir()
    folder = str(tmp_path / "stream")
    seen = []

    def go(options=OPTIONS):
        source = stream_log(spark, str(logs), "(never)")
        query = start_closed_buckets(source, folder, options, sink=lambda points, batch: seen.append(points.count()))
        query.awaitTermination()
        return query

    (logs / "1.log").write_text("\n".join(lines[:120]) + "\n")
    go()
    (logs / "2.log").write_text("\n".join(lines[120:]) + "\n")
    query = go()
    whole = MetricsRuns(spark, str(tmp_path / "whole"), OPTIONS)
    whole.run(lines_of(*lines))
    gzip_free = "measurement <> 'gzip_count'"
    streamed = closed_bucket_points(spark, folder)
    assert point_set(streamed.where(gzip_free)) == point_set(whole.points().where(gzip_free))
    assert sum(seen) == streamed.count()
    observed = [p.observedMetrics["lines"] for p in query.recentProgress if "lines" in p.observedMetrics]
    assert sum(o.parsed_lines for o in observed) == 120
    with pytest.raises(OptionMismatch):
        go(RunOptions(bucket_duration=30, skip_to_end=False))
    with pytest.raises(ValueError):
        go(RunOptions(skip_to_end=True))


def test_watermark_is_inclusive(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "1.log").write_text("\n".join(at(1, 2, 3, 5)) + "\n")
    folder = str(tmp_path / "stream")
    start_closed_buckets(stream_log(spark, str(logs)), folder, OPTIONS).awaitTermination()
    rows = closed_bucket_points(spark, folder).where("measurement = 'hits'").collect()
    assert sorted(r.bucket for r in rows) == [1, 2, 3]
