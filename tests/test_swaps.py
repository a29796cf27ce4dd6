"""Sinks under failure: every step of a swap fails or dies, and two runs create a table at a time."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from funnelspark.sources import recover, write_hour, write_hours, write_once
from funnelspark.sources.sinks import Files

HOUR, NEXT = "2024-01-10T05", "2024-01-10T06"


def rows(spark, path):
    if not any(d.startswith("dt=") for d in os.listdir(path)):
        return {}
    return {r.dt: r.n for r in spark.read.schema("id bigint, dt string").parquet(path).groupBy("dt").agg(F.count("*").alias("n")).collect()}


class Died(BaseException):
    """Not an Exception: nothing of the sink runs after it."""


def failing(monkeypatch, step, error):
    """The step-th rename or deletion in the table's folder fails from now on, once."""
    done = []

    def wrap(name):
        real = getattr(Files, name)

        def call(self, path, *to):
            if "/dt=" in path or name == "delete":
                done.append(path)
                if len(done) == step:
                    raise error
            return real(self, path, *to)

        monkeypatch.setattr(Files, name, call)

    wrap("move")
    wrap("delete")


@pytest.mark.parametrize("step", [1, 2, 3, 4])
@pytest.mark.parametrize("error", [OSError("no"), Died()], ids=["fails", "dies"])
def test_old_or_new_rows_at_every_step(spark, tmp_path, monkeypatch, step, error):
    """Renamed away, renamed in, plan deleted, folder deleted."""
    path = str(tmp_path / "out")
    write_hour(spark.range(3), path, HOUR)
    write_hour(spark.range(2), path, NEXT)
    with monkeypatch.context() as m:
        failing(m, step, error)
        with pytest.raises(type(error)):
            write_hour(spark.range(7), path, HOUR)
    if isinstance(error, OSError):
        assert rows(spark, path) == {HOUR: 3 if step <= 2 else 7, NEXT: 2}
    recover(spark, path)
    expected = {HOUR: 3 if isinstance(error, OSError) and step <= 2 else 7, NEXT: 2}
    assert rows(spark, path) == expected
    write_hour(spark.range(4), path, HOUR)
    assert rows(spark, path) == {HOUR: 4, NEXT: 2}


def test_next_run_of_the_hour_ends_a_dead_swap_first(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    write_hour(spark.range(3), path, HOUR)
    with monkeypatch.context() as m:
        failing(m, 2, Died())
        with pytest.raises(Died):
            write_hour(spark.range(7), path, HOUR)
    write_hour(spark.range(2), path, NEXT)  # another hour leaves it alone
    assert rows(spark, path) == {NEXT: 2}
    with pytest.raises(Exception, match="boom"):
        write_hour(spark.range(4).withColumn("id", F.expr("raise_error('boom')").cast("long")), path, HOUR)
    assert rows(spark, path) == {HOUR: 7, NEXT: 2}
    assert not [d for d in os.listdir(path) if d.startswith("_swap")]


def hourly(spark, counts):
    made = [spark.range(n).withColumn("at", F.lit(f"{hour}:00:00Z")) for hour, n in counts.items()]
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def test_range_of_hours_replaces_and_empties(spark, tmp_path):
    path = str(tmp_path / "out")
    h = [f"2024-01-10T0{i}" for i in range(5)]
    write_hours(hourly(spark, {h[0]: 1, h[1]: 2, h[2]: 3, h[3]: 4}), path, h[0], h[4])
    assert rows(spark, path) == {h[0]: 1, h[1]: 2, h[2]: 3, h[3]: 4}
    write_hours(hourly(spark, {h[1]: 5, h[3]: 6}), path, h[1], h[4])
    assert rows(spark, path) == {h[0]: 1, h[1]: 5, h[3]: 6}
    write_hours(hourly(spark, {h[1]: 0}), path, h[0], h[2])
    assert rows(spark, path) == {h[3]: 6}


@pytest.mark.parametrize("at", ["2024-01-10T04:00:00Z", "2024-01-10T02:00:00Z", None])
def test_range_of_hours_refuses_other_rows(spark, tmp_path, at):
    path = str(tmp_path / "out")
    write_hours(hourly(spark, {"2024-01-10T03": 2}), path, "2024-01-10T03", "2024-01-10T04")
    with pytest.raises(Exception, match="write_hours: row of hour"):
        write_hours(spark.range(1).withColumn("at", F.lit(at).cast("string")), path, "2024-01-10T03", "2024-01-10T04")
    with pytest.raises(ValueError, match="column dt"):
        write_hours(spark.range(1).selectExpr("id", "'' as at", "'' as dt"), path, "2024-01-10T03", "2024-01-10T04")
    assert rows(spark, path) == {"2024-01-10T03": 2} and not [d for d in os.listdir(path) if d.startswith("_")]


@pytest.mark.parametrize("step", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("error", [OSError("no"), Died()], ids=["fails", "dies"])
def test_range_of_hours_goes_through_or_not_at_all(spark, tmp_path, monkeypatch, step, error):
    path, h = str(tmp_path / "out"), [f"2024-01-10T0{i}" for i in range(4)]
    write_hours(hourly(spark, {h[0]: 1, h[1]: 2, h[2]: 3}), path, h[0], h[3])
    with monkeypatch.context() as m:
        failing(m, step, error)  # two renames for hours 0 and 1, one for hour 2
        with pytest.raises(type(error)):
            write_hours(hourly(spark, {h[0]: 10, h[1]: 20}), path, h[0], h[3])
    recover(spark, path)
    assert rows(spark, path) == ({h[0]: 1, h[1]: 2, h[2]: 3} if isinstance(error, OSError) else {h[0]: 10, h[1]: 20})


def test_write_once_without_success_files(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        path = str(tmp_path / "t")
        write_once(spark.range(3), "unmarked", path)
        spark.range(7).write.saveAsTable("unmarked_managed")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not os.path.exists(f"{path}/_SUCCESS")
    write_once(spark.range(9), "unmarked_managed")
    spark.sql("drop table unmarked")
    write_once(spark.range(9), "unmarked", path)
    assert spark.table("unmarked").count() == 3 and spark.table("unmarked_managed").count() == 7


def test_second_of_two_runs_discards_its_work(spark, tmp_path, monkeypatch):
    """Another run publishes after this one has found nothing and written its rows."""
    path = str(tmp_path / "t")
    real = Files.write

    def write(self, to, text):
        monkeypatch.setattr(Files, "write", real)
        write_once(spark.range(5), "raced", path)
        real(self, to, text)

    monkeypatch.setattr(Files, "write", write)
    write_once(spark.range(9), "raced", path)
    assert spark.table("raced").count() == 5 and os.listdir(tmp_path) == ["t"]


def test_runs_at_a_time(spark, tmp_path):
    path, errors = str(tmp_path / "t"), []

    def run(n):
        try:
            write_once(spark.range(n).repartition(3), "together", path)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=run, args=(n,)) for n in (3, 5, 8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    spark.catalog.refreshTable("together")
    assert not errors and spark.table("together").count() in (3, 5, 8) and os.listdir(tmp_path) == ["t"]


def test_write_once_dies_before_publishing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as m:
        m.setattr(Files, "move", lambda *_: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            write_once(spark.range(3), "died", path)
    assert not os.path.exists(path) and not spark.catalog.tableExists("died")
    write_once(spark.range(4), "died", path)
    assert spark.table("died").count() == 4
