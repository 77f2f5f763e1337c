from __future__ import annotations

import glob
import os

import pytest
from samples import bare_line, line

from tallyweir.operators.outbox import replayed, retained
from tallyweir.operators.partials import partial_metrics
from tallyweir.operators.points import points_from_partials
from tallyweir.sources.logs import cap_lines, read_log
from tallyweir.sources.scratch import shared_folder, written
from tallyweir.sources.sinks import batch_bodies, register_measurements, send_lines, write_lines, write_points


@pytest.fixture
def logs(tmp_path):
    for host, count in (("web1", 5), ("web2", 3)):
        folder = tmp_path / "logs" / host
        folder.mkdir(parents=True)
        (folder / "access.log.1").write_text("".join(line(loctag=f"{host}-{i}") + "\r\n" for i in range(count)))
    (tmp_path / "logs" / "web1" / "access.log.2").write_text(line(loctag="web1-5") + "\n" + line(loctag="web1-6"))
    return str(tmp_path / "logs")


def test_scan_with_sources(spark, logs):
    rows = read_log(spark, f"{logs}/*", r"/([^/]+)/access\.log").collect()
    assert sorted((r.source, r.value.split("|")[4]) for r in rows) == sorted(
        [("web1", f"web1-{i}") for i in range(7)] + [("web2", f"web2-{i}") for i in range(3)]
    )
    assert {r.source for r in read_log(spark, f"{logs}/*").collect()} == {r.file for r in rows}
    assert partial_metrics(read_log(spark, f"{logs}/*")).where("kind = 'skip'").count() == 0


@pytest.mark.parametrize("cap", [1, 4, 5, 6, 7, 100])
def test_cap_per_source(spark, logs, cap):
    lines = read_log(spark, f"{logs}/*", r"/([^/]+)/access\.log")
    kept = sorted(r.value.split("|")[4] for r in cap_lines(lines, cap).collect())
    want = [f"web1-{i}" for i in range(min(cap, 7))] + [f"web2-{i}" for i in range(min(cap, 3))]
    assert kept == want
    assert cap_lines(lines, 0).count() == 10


def test_cap_inside_a_block(spark):
    lines = spark.range(100).selectExpr(
        "if(id % 3 = 0, 'rare', 'often') AS source", "string(id) AS value", "'f' AS file", "id div 10 AS block", "id AS seq"
    )
    for cap in (1, 9, 25, 1000):
        got = {s: sorted(int(r.value) for r in cap_lines(lines, cap).collect() if r.source == s) for s in ("rare", "often")}
        assert got["rare"] == [i for i in range(100) if i % 3 == 0][:cap]
        assert got["often"] == [i for i in range(100) if i % 3][:cap]


def test_cap_needs_the_place_of_lines(spark):
    with pytest.raises(ValueError, match="block"):
        cap_lines(spark.sql("SELECT 'a' AS source, 'b' AS value"), 5)


def twelve_lines(spark, partitions=1):
    return spark.range(0, 12, 1, partitions).selectExpr("concat('l', id) AS line")


def test_batches_of_five(spark):
    bodies = batch_bodies(twelve_lines(spark), 5).collect()
    assert sorted(b.points for b in bodies) == [2, 5, 5]
    assert all(b.body.endswith("\n") and b.body.count("\n") == b.points for b in bodies)
    assert sorted("".join(b.body for b in bodies).split()) == sorted(f"l{i}" for i in range(12))


def test_batches_fill_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert sorted(b.points for b in batch_bodies(twelve_lines(spark), 5).collect()) == [2, 5, 5]
        for wrong in (batch_bodies, lambda lines, size: send_lines(lines, print, size)):
            with pytest.raises(ValueError):
                wrong(twelve_lines(spark), 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(("partitions", "size"), [(1, 1), (3, 5), (12, 5), (20, 5), (5, 100), (4, 4), (7, 6)])
def test_bodies_are_full_across_partitions(spark, partitions, size):
    bodies = sorted(batch_bodies(twelve_lines(spark, partitions), size).collect())
    assert [b.number for b in bodies] == list(range(len(bodies)))
    assert [b.points for b in bodies] == [min(size, 12 - size * i) for i in range(len(bodies))]
    assert "".join(b.body for b in bodies) == "".join(f"l{i}\n" for i in range(12))


def test_no_lines_give_no_bodies(spark):
    assert batch_bodies(twelve_lines(spark).limit(0)).collect() == []


def test_sending_from_the_executors(spark, tmp_path):
    target = str(tmp_path)

    def send(body):
        import uuid

        with open(f"{target}/{uuid.uuid4().hex}.txt", "w") as file:
            file.write(body)

    send_lines(twelve_lines(spark, 2), send, 5)
    bodies = [open(p).read() for p in glob.glob(f"{target}/*.txt")]
    assert sorted(b.count("\n") for b in bodies) == [2, 5, 5]


def test_bodies_are_sent_once(spark, tmp_path, monkeypatch):
    import tallyweir.sources.ledger as ledger

    monkeypatch.setattr(ledger, "WAVE", 2)
    target = tmp_path / "store"
    target.mkdir()
    fails = tmp_path / "fails"

    def send(body, target=str(target), fails=str(fails)):
        import os
        import uuid

        if os.path.exists(fails) and "l7" in body:
            raise OSError("away")
        with open(f"{target}/{uuid.uuid4().hex}", "w") as file:
            file.write(body)

    points = spark.range(12).selectExpr("id", "3L AS run")
    once = ledger.SendOnce(spark, f"{tmp_path}/ledger", send, lambda p: p.selectExpr("concat('l', id) AS line"), batch_size=2)
    fails.touch()
    with pytest.raises(Exception, match="away"):
        once(points)
    fails.unlink()
    once(points)
    once(points)
    sent = "".join(open(p).read() for p in target.iterdir()).split()
    assert set(sent) == {f"l{i}" for i in range(12)} and once.sent == 12
    # but for what the failed wave had sent, nothing arrives twice
    assert len(sent) <= 12 + 2
    other = ledger.SendOnce(spark, f"{tmp_path}/ledger", send, once.lines_of, epoch=1, batch_size=2)
    other(points)
    assert other.sent == 12 and sum(r.points for r in other.ledger(3).collect()) == 12


def test_text_output(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_lines(twelve_lines(spark), path, 5)
    files = [p for p in glob.glob(f"{path}/part-*")]
    assert sorted(open(p).read().count("\n") for p in files) == [2, 5, 5]
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(f"l{i}" for i in range(12))


def test_points_are_read_back_by_measurement(spark, lines_of, tmp_path):
    points = points_from_partials(written(partial_metrics(lines_of(line(), bare_line("9"))), "test"))
    path = str(tmp_path / "points")
    write_points(points, path)
    assert "measurement=hits" in os.listdir(path)
    register_measurements(spark, path, ["hits", "status"], prefix="t_")
    assert spark.sql("SELECT count(value) AS n, sum(value) AS s FROM t_hits").first()[:] == (2, 2.0)
    plan = spark.table("t_status")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement" in plan
    assert spark.table("t_status").columns[-1] == "value"


def test_outbox_keeps_whole_sends(spark):
    saved = spark.range(30).selectExpr("id div 3 AS run", "id AS point")
    assert sorted({r.run for r in retained(saved, 4).collect()}) == [6, 7, 8, 9]
    assert retained(saved, 4).count() == 12
    assert retained(saved, 0).count() == 0
    new = spark.range(2).selectExpr("10L AS run", "id AS point")
    out = replayed(saved, new, 1).collect()
    assert sorted((r.run, r.resent) for r in out) == [(9, True)] * 3 + [(10, False)] * 2


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root) and first != second
