import pytest

from funnelspark.operators import dimensions
from funnelspark.sources import latest_partition

AS_OF = "timestamp'2024-01-10 00:00:00'"


def snapshots(spark, days):
    return spark.createDataFrame([(d, "r1") for d in days], "dt string, v string")


@pytest.mark.parametrize(
    "days,want",
    [
        (["2024-01-08", "2024-01-09", "2024-01-01"], "2024-01-09"),
        (["2024-01-08T00", "2024-01-07T23"], "2024-01-08T00"),  # the limit itself is inside
        (["2024-01-07", "2024-01-01"], None),
        ([], None),
    ],
)
def test_latest_partition(spark, days, want):
    assert latest_partition(snapshots(spark, days), 2, AS_OF).first().latest_dt == want


def test_no_recent_snapshot_gives_no_rows(spark):
    assert dimensions.newest_snapshot(snapshots(spark, ["2024-01-01"]), 2, AS_OF).count() == 0


def test_newest_snapshot_prunes_partitions(spark, tmp_path):
    df = snapshots(spark, ["2024-01-08", "2024-01-09", "2024-01-01"])
    df.write.partitionBy("dt").parquet(str(tmp_path / "s"))
    read = spark.read.schema("v string, dt string").parquet(str(tmp_path / "s"))
    newest = dimensions.newest_snapshot(read, 2, AS_OF)
    assert [r.dt for r in newest.collect()] == ["2024-01-09"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<>" in plan


def test_primary_goal(spark):
    goals = spark.createDataFrame(
        [
            (1, 2, "cpa", 1.0),
            (1, 1, "pacing-model", 2.0),
            (1, 3, "cpa", 3.0),
            (2, 1, "roas", 5.0),
            (2, 1, "cpa", 9.0),
            (3, None, "cpa", 1.0),
            (4, 1, None, 1.0),
        ],
        "campaign_id bigint, priority int, type string, target_value double",
    )
    got = {r.campaign_id: (r.type, r.target_value) for r in dimensions.primary_goal(goals).collect()}
    assert got == {1: ("cpa", 1.0), 2: ("cpa", 9.0)}
    assert "WindowGroupLimit" in dimensions.primary_goal(goals)._jdf.queryExecution().executedPlan().toString()


def test_attach_keeps_and_fans_out(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, m int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "id int, name string")
    got = sorted((r.k or 0, r.m, r.label or "") for r in dimensions.attach(facts, dim, {"k": "id"}, {"name": "label"}).collect())
    assert got == [(0, 30, ""), (1, 10, "a"), (1, 10, "b"), (2, 20, "")]
    assert [(r.id, r.n) for r in dimensions.repeated_keys(dim, ["id"]).collect()] == [(1, 2)]


def test_crm_v2_needs_all_three_and_an_enabled_campaign(spark):
    campaigns = spark.createDataFrame(
        [(1, 11, "enabled", "c1"), (2, 12, "paused", "c2"), (3, 13, "enabled", "c3")],
        "id bigint, customer_id bigint, state string, salesforce_campaign_id string",
    )
    crm = spark.createDataFrame(
        [("c1", "EU", None, "gold", "o1", "2024-01-09"), ("c2", "EU", None, "gold", "o1", "2024-01-09"), ("c3", "US", None, "gold", "gone", "2024-01-09")],
        "campaign_id_18_digit__c string, sales_region__c string, sales_sub_region__c string, service_level__c string, opportunity__c string, dt string",
    )
    opportunities = spark.createDataFrame(
        [("o1", "zone", "2024-01-08"), ("o1", "old", "2024-01-07")], "opportunity_id_18_digit__c string, scale_zone__c string, dt string"
    )
    got = dimensions.crm_campaign_v2(crm, opportunities, campaigns, AS_OF).collect()
    assert [(r.campaign_id, r.customer_id, r.scale_zone) for r in got] == [(1, 11, "zone")]
