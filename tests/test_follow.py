"""Logs that grow, rotate, are copied, truncated, compressed and torn between runs: each line is read once."""

from __future__ import annotations

import gzip
import os
import random
import shutil

import pytest
from samples import bare_line

from tallyweir import LogFiles, MetricsRuns, RunOptions
from tallyweir.sources import follow as module
from tallyweir.sources.follow import FILES_SCHEMA, follow


class Follower:
    """Runs over one folder of logs, each with the state that the one before left."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        self.logs = LogFiles(f"{root}/logs/*/*", r"/([^/]+)/[^/]+$", r"[.]log[.](\d+)")
        self.state = spark.createDataFrame([], FILES_SCHEMA)
        self.clock = 1_700_000_000

    def path(self, name):
        path = f"{self.root}/logs/{name if '/' in name else 'web/' + name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return path

    def write(self, name, text, mode="w"):
        with (gzip.open if name.endswith(".gz") else open)(self.path(name), mode + "t", newline="", encoding="utf-8") as file:
            file.write(text)
        self.touch(name)

    def add(self, name, text):
        self.write(name, text, "a")

    def touch(self, name):
        self.clock += 1
        os.utime(self.path(name), (self.clock, self.clock))

    def rename(self, old, new):
        os.rename(self.path(old), self.path(new))

    def read(self, most=0):
        folder, self.n = f"{self.root}/state{self.n}", self.n + 1
        out = [r.value for r in follow(self.spark, self.logs, self.state, folder, most).collect()]
        self.state = self.spark.read.schema(FILES_SCHEMA).parquet(f"{folder}/files")
        return sorted(out)

    def opened(self):
        return {os.path.basename(r.file) for r in self.spark.read.parquet(f"{self.root}/state{self.n - 1}/seen").collect()}


@pytest.fixture
def logs(spark, tmp_path):
    return Follower(spark, str(tmp_path))


def text(*numbers):
    return "".join(f"line {n}\n" for n in numbers)


def lines(*numbers):
    return sorted(f"line {n}" for n in numbers)


def test_a_log_that_grows(logs):
    logs.write("a.log", text(1, 2, 3))
    assert logs.read() == lines(1, 2, 3)
    assert logs.read() == [] and logs.opened() == set()
    logs.add("a.log", text(4, 5))
    assert logs.read() == lines(4, 5)
    logs.touch("a.log")
    assert logs.read() == [] and logs.opened() == {"a.log"}


def test_renamed_and_begun_anew(logs):
    logs.write("a.log", text(1, 2, 3))
    assert logs.read() == lines(1, 2, 3)
    logs.add("a.log", text(4))
    logs.rename("a.log", "a.log.1")
    logs.write("a.log", text(*range(10, 15)))
    assert logs.read() == lines(4, *range(10, 15))
    logs.rename("a.log.1", "a.log.2")
    logs.rename("a.log", "a.log.1")
    logs.write("a.log", text(20))
    assert logs.read() == lines(20)
    assert logs.read() == []


def test_copied_and_truncated(logs):
    logs.write("a.log", text(1, 2, 3))
    assert logs.read() == lines(1, 2, 3)
    logs.add("a.log", text(4))
    shutil.copy(logs.path("a.log"), logs.path("a.log.1"))
    # both are there for a moment, and are one log
    assert logs.read() == lines(4)
    logs.write("a.log", text(5, 6))
    assert logs.read() == lines(5, 6)
    logs.add("a.log", text(7))
    assert logs.read() == lines(7)


def test_compressed_after_rotation(logs):
    logs.write("a.log", text(1, 2))
    assert logs.read() == lines(1, 2)
    logs.add("a.log", text(3))
    os.remove(logs.path("a.log"))
    logs.write("a.log.1.gz", text(1, 2, 3))
    logs.write("a.log", text(4))
    assert logs.read() == lines(3, 4)


def test_a_line_without_its_end_waits(logs):
    logs.write("a.log", text(1, 2) + "lin")
    assert logs.read() == lines(1, 2)
    logs.add("a.log", "e 3\nline 4\nl")
    assert logs.read() == lines(3, 4)
    logs.rename("a.log", "a.log.1")
    logs.add("a.log.1", "ine 5\n")
    logs.write("a.log", "line")
    assert logs.read() == lines(5)
    logs.add("a.log", " 6\n")
    assert logs.read() == lines(6)


def test_marks_line_ends_and_empty_files(logs):
    logs.write("a.log", "﻿line 1\r\nline 2\r\né")
    logs.write("b/b.log", "")
    logs.write("c/c.log", "\n\nline 9\n")
    assert logs.read() == sorted(["line 1\r", "line 2\r", "", "", "line 9"])
    logs.add("a.log", "\r\n")
    logs.add("b/b.log", text(7))
    assert logs.read() == sorted(["é\r", "line 7"])


def test_only_changed_files_are_opened(spark, logs):
    for i in range(50):
        logs.write(f"a.log.{i + 1}", text(*range(100 * i, 100 * i + 3)))
    assert len(logs.read()) == 150
    logs.write("a.log", text(9999))
    assert logs.read() == lines(9999) and logs.opened() == {"a.log"}
    plan = logs.logs.lines(spark, [r.file for r in logs.state.collect() if r.file.endswith("a.log")])
    assert plan.count() == 1
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in scan and _files_read(plan) == 1


def _files_read(frame):
    """The files that the scan of a plan has chosen."""
    scan = frame._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    return scan.inputRDD().partitions() and sum(len(p.files()) for p in scan.inputRDD().partitions())


def test_gone_logs_are_forgotten_in_time(logs, monkeypatch):
    monkeypatch.setattr(module, "KEPT_RUNS", 2)
    logs.write("a.log", text(1, 2))
    logs.write("b.log", text(8))
    assert logs.read() == lines(1, 2, 8)
    os.rename(logs.path("a.log"), f"{logs.root}/aside")
    assert logs.read() == [] and logs.state.count() == 2
    shutil.copy2(f"{logs.root}/aside", logs.path("a.log.1"))
    assert logs.read() == []
    os.remove(logs.path("a.log.1"))
    for _ in range(3):
        assert logs.read() == []
    assert logs.state.count() == 1


def test_a_cap_goes_on_in_order_over_a_rename(logs):
    logs.write("a.log.1", text(*range(5)))
    logs.write("a.log", text(*range(5, 9)))
    logs.write("b/b.log", text(50))
    assert logs.read(3) == lines(0, 1, 2, 50)
    logs.rename("a.log.1", "a.log.2")
    logs.rename("a.log", "a.log.1")
    logs.write("a.log", text(9, 10))
    got = []
    while part := logs.read(3):
        assert len(part) <= 3
        got.append(part)
    assert got == [lines(3, 4, 5), lines(6, 7, 8), lines(9, 10)]


def test_files_of_many_small_splits(spark, logs):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    try:
        logs.write("a.log", text(*range(20)) + "lin")
        assert logs.read(15) == lines(*range(15))
        logs.add("a.log", "e 20\n" + text(*range(21, 45)))
        logs.rename("a.log", "a.log.1")
        logs.write("a.log", text(*range(100, 103)))
        assert logs.read() == lines(*range(15, 45), *range(100, 103))
        assert logs.read() == []
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_long_logs_that_begin_alike_are_one_only_if_they_are(logs):
    same = [f"line {i}" for i in range(40)]
    logs.write("a.log", "\n".join([*same, "x"]) + "\n")
    logs.write("a.log.1", "\n".join(same) + "\n")
    logs.write("b/a.log", "\n".join(same) + "\n")
    assert logs.read() == sorted([*same, "x", *same])
    logs.add("a.log", "y\n")
    assert logs.read() == ["y"]


def test_any_order_of_events_reads_each_line_once(logs):
    rng = random.Random(11)
    number, got, torn = 0, [], False
    logs.write("a.log", "")
    for _ in range(14):
        for _ in range(rng.randrange(4)):
            what = rng.random()
            if what < 0.6 or torn:
                logs.add("a.log", (f" {number}\n" if torn else "") + text(*range(number + torn, number + torn + 3)))
                number, torn = number + torn + 3, False
                if rng.random() < 0.4:
                    logs.add("a.log", "line")
                    torn = True
            elif what < 0.8:
                for i in (3, 2, 1):
                    if os.path.exists(logs.path(f"a.log.{i}")):
                        logs.rename(f"a.log.{i}", f"a.log.{i + 1}")
                logs.rename("a.log", "a.log.1")
                logs.write("a.log", "")
        got += logs.read(rng.choice([0, 0, 4]))
    if torn:
        logs.add("a.log", f" {number}\n")
        number += 1
    while part := logs.read():
        got += part
    assert sorted(got) == lines(*range(number))


def test_runs_follow_files(spark, tmp_path):
    logs = Follower(spark, str(tmp_path))
    options = RunOptions(bucket_duration=60, lookback_factor=2, skip_to_end=False)
    runs = MetricsRuns(spark, f"{tmp_path}/runs", options)
    minute = lambda *at: "".join(bare_line(60.0 * m - 30) + "\n" for m in at)
    logs.write("a.log", minute(1, 2) + bare_line(150.0)[:9])
    assert runs.run(logs.logs).parsed_lines == 2
    logs.add("a.log", bare_line(150.0)[9:] + "\n")
    logs.rename("a.log", "a.log.1")
    logs.write("a.log", minute(4, 5, 6))
    stats = runs.run(logs.logs)
    assert (stats.parsed_lines, stats.skipped_lines) == (4, 0)
    assert runs.run(logs.logs).parsed_lines == 0
    assert sorted((r.bucket, r.value_i) for r in runs.points().where("measurement = 'hits'").collect()) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    # a new epoch knows no files; lines without a place leave the files known
    again = MetricsRuns(spark, f"{tmp_path}/runs", options, start_over=True)
    assert again.run(logs.logs).parsed_lines == 6
    again.run(spark.createDataFrame([(bare_line(600.0), "web")], "value string, source string"))
    assert again.run(logs.logs).parsed_lines == 0


def test_only_a_cell_is_numbered_where_a_log_goes_on(spark, logs, monkeypatch):
    monkeypatch.setattr(module, "CELL_LINES", 16)
    first, more = text(*range(200)), text(*range(200, 300))
    logs.write("a.log", first)
    assert logs.read() == sorted(first.splitlines())
    logs.add("a.log", more)
    assert logs.read() == sorted(more.splitlines())
    blocks = spark.read.parquet(f"{logs.root}/state{logs.n - 1}/blocks")
    cut = blocks.where("low < high AND high - low < n").collect()
    assert len(cut) <= 1 and all(r.n <= 16 for r in cut) and blocks.agg({"n": "sum"}).first()[0] == 300
