"""Training from stored daily sketches, beside training from the impressions themselves."""

import pytest

from funnelspark.plans import daily_sketches_v1, daily_sketches_v2, stored_segments_v1, stored_segments_v2, train_segments_v1, train_segments_v2
from funnelspark.sources import SCHEMAS, PartitionedTable, open_table, write_hours

DAY = 86_400_000
START = 1683590400000  # 2023-05-09


def impressions(spark, root):
    """Nine days around a week; hour 00, late partitions, unusable values, null keys and a third platform included."""
    rows = []
    for i in range(3000):
        day, hour = i % 9 - 1, i % 24
        at = START + day * DAY + hour * 3_600_000 + (DAY if i % 50 == 7 else -DAY if i % 50 == 9 else 0)
        stamp = START + day * DAY
        dt = f"2023-05-{8 + i % 9:02d}T{hour:02d}"
        assert stamp
        rows.append(
            {
                "at": at, "dt": dt,
                "bid__app_platform": ["IOS", "ANDROID", "WEB", None][i % 31 % 4],
                "bid__price_data__model_type": ["revenue", "revenue-v3", "install", ""][i % 13 % 4],
                "bid__bid_request__exchange": ["UNITY", "other", None][i % 3],
                "bid__creative__ad_format": ["video", "native"][i % 2],
                "bid__price_data__conversion_likelihood": float("nan") if i % 41 == 0 else None if i % 43 == 0 else (i * 7919 % 997) / 10,
                "bid__price_data__compensated_margin_bid_multiplier": [0.5, 2.0, 0.0][i % 37 % 3],
                "bid__auction_result__winner__price_cpm_micros": i * 104729 % 1009,
                "bid__price_cpm_micros": i % 500,
            }
        )
    schema = SCHEMAS["impressions"]
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)
    df.write.partitionBy("dt").parquet(f"{root}/impressions")
    return open_table(spark, root, "impressions")


def lists(segments, keys):
    return {tuple(r[k] for k in keys): {a: [tuple(c) for c in r[a]] for a in r.asDict() if a not in keys} for r in segments.collect()}


@pytest.mark.parametrize(
    "name, sketch, stored, train, keys",
    [
        ("bucket_sketches_v1", daily_sketches_v1, stored_segments_v1, train_segments_v1, ("platform", "model_type", "exchange_group", "ad_format_group")),
        ("bucket_sketches_v2", daily_sketches_v2, stored_segments_v2, train_segments_v2, ("platform", "model_type")),
    ],
)
def test_windows_of_stored_days(spark, tmp_path, name, sketch, stored, train, keys):
    """With fewer values than a sketch holds, cuts are the same as from one pass over the window."""
    seen = impressions(spark, str(tmp_path))
    path = f"{tmp_path}/{name}"
    write_hours(sketch(seen, "2023-05-08", "2023-05-12"), path, "2023-05-08", "2023-05-12", at="day")
    for day in range(12, 17):
        write_hours(sketch(seen, f"2023-05-{day}"), path, f"2023-05-{day}", f"2023-05-{day + 1}", at="day")
    table = PartitionedTable(spark, str(tmp_path), name)
    assert len(table.partitions()) == 9
    for start, end in (("2023-05-09T00", "2023-05-16T00"), ("2023-05-08T00", "2023-05-17T00"), ("2023-05-11T00", "2023-05-12T00")):
        got, want = lists(stored(table, start, end), keys), lists(train(seen, start, end), keys)
        assert got == want and len(got) > 3
    with pytest.raises(ValueError, match="whole days"):
        stored(table, "2023-05-09T01", "2023-05-16T00")


def test_a_daily_run_reads_its_day_and_a_window_no_impressions(spark, tmp_path):
    seen = impressions(spark, str(tmp_path))
    days = {f.split("dt=")[1][:10] for f in daily_sketches_v1(seen, "2023-05-10").inputFiles()}
    assert days == {"2023-05-10"}
    path = f"{tmp_path}/bucket_sketches_v1"
    write_hours(daily_sketches_v1(seen, "2023-05-09", "2023-05-17"), path, "2023-05-09", "2023-05-17", at="day")
    read = stored_segments_v1(PartitionedTable(spark, str(tmp_path), "bucket_sketches_v1"), "2023-05-09T00", "2023-05-16T00").inputFiles()
    assert read and all("bucket_sketches_v1/dt=2023-05-" in f for f in read)
