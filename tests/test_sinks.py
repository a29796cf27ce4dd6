import os

import pytest
from pyspark.sql import functions as F

from funnelspark.sources import intermediates, shared_folder, via_shared_table, write_hour, write_once


def hours(spark, path):
    got = spark.read.schema("id bigint, dt string").parquet(path).groupBy("dt").count().collect()
    return {r.dt: r["count"] for r in got}


def test_write_hour_replaces_only_its_hour(spark, tmp_path):
    path = str(tmp_path / "out")
    for hour, n in (("2024-01-10T05", 3), ("2024-01-10T06", 2), ("2024-01-10T05", 4), ("2024-01-10T05", 4)):
        write_hour(spark.range(n), path, hour)
    assert hours(spark, path) == {"2024-01-10T05": 4, "2024-01-10T06": 2}


def test_write_hour_of_no_rows_empties_the_hour(spark, tmp_path):
    path = str(tmp_path / "out")
    for hour, n in (("2024-01-10T05", 3), ("2024-01-10T06", 2), ("2024-01-10T05", 0)):
        write_hour(spark.range(n), path, hour)
    assert hours(spark, path) == {"2024-01-10T06": 2}


def test_write_hour_refuses_other_hours_and_keeps_what_was(spark, tmp_path):
    path, hour = str(tmp_path / "out"), "2024-01-10T05"
    report = spark.range(2).selectExpr("id", "'2024-01-10T05:00:00Z' as `at`")
    write_hour(report, path, hour)
    with pytest.raises(Exception, match="write_hour"):
        write_hour(report.unionByName(spark.range(1).selectExpr("id", "'2024-01-10T06:00:00Z' as `at`")), path, hour)
    assert hours(spark, path) == {hour: 2}
    assert [d for d in os.listdir(path) if d.startswith("_writing")] == []


@pytest.mark.parametrize("own_path", [True, False])
def test_write_once_keeps_first(spark, tmp_path, own_path):
    table = f"once_{own_path}".lower()
    path = str(tmp_path / "t") if own_path else None
    write_once(spark.range(3), table, path)
    write_once(spark.range(9), table, path)
    assert spark.table(table).count() == 3
    # Another catalog doesn't know the table, but the folder is there.
    spark.sql(f"drop table {table}")
    write_once(spark.range(9), table, path)
    assert spark.table(table).count() == 3


@pytest.mark.parametrize("own_path", [True, False])
def test_write_once_repeats_an_unfinished_run(spark, tmp_path, own_path):
    table = f"half_{own_path}".lower()
    path = str(tmp_path / "t") if own_path else f"{spark.conf.get('spark.sql.warehouse.dir').removeprefix('file:')}/{table}"
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    write_once(spark.range(3), table, path if own_path else None)
    assert spark.table(table).count() == 3


def test_write_once_keeps_a_table_of_another_place(spark, tmp_path):
    spark.range(4).write.saveAsTable("elsewhere")
    write_once(spark.range(9), "elsewhere", str(tmp_path / "t"))
    assert spark.table("elsewhere").count() == 4 and not os.path.exists(tmp_path / "t")


def test_shared_table_survives_its_source(spark):
    folder = shared_folder(spark)
    df = via_shared_table(spark.range(5).withColumn("y", F.col("id") * 2), "t")
    assert df.count() == 5 and folder in df.inputFiles()[0]


def test_nothing_is_left_and_no_setting_changed(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    have = set(os.listdir(folder))
    with intermediates(spark):
        assert via_shared_table(spark.range(5), "t").count() == 5
        assert set(os.listdir(folder)) != have
    assert set(os.listdir(folder)) == have
    with intermediates(spark):
        with intermediates(spark):
            pass
        with intermediates(spark):
            kept = via_shared_table(via_shared_table(spark.range(5), "t"), "u", outlive=True)
        assert kept.count() == 5
    assert set(os.listdir(folder)) == have and spark.conf.get("spark.checkpoint.dir", None) == before
