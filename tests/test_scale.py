"""What a single task gets does not grow with the input."""

import math
import os
import re
import time
from fractions import Fraction
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.numbers import exact_sum
from funnelspark.operators import dimensions, metrics, percentiles
from funnelspark.plans import health
from funnelspark.sources import SCHEMAS, sinks
from workload import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 3, 1000, 1001, 2500, 4999, 5000, 2_000_000_000])
def test_limited_gives_as_many_rows_as_asked_for(spark, n):
    rows = spark.range(0, 5000, 1, 3).where("id < 1700 or id >= 3300 or id % 7 = 0").selectExpr("id % 11 as a", "id as `b.c`", "cast(null as double) as d")
    whole = {r["b.c"] for r in rows.collect()}
    got = sinks.limited(rows, n)
    kept = [r["b.c"] for r in got.collect()]
    assert got.columns == rows.columns
    assert len(kept) == len(set(kept)) == min(n, len(whole))
    assert set(kept) <= whole


def test_many_limited_rows_stay_where_they_are(spark):
    got = sinks.limited(spark.range(0, 50_000, 1, 5).toDF("a"), 2_000_000_000)
    assert "GlobalLimit" not in plan(got)
    assert len({r.p for r in got.select(F.spark_partition_id().alias("p")).distinct().collect()}) > 1


def test_hours_of_stored_tables_are_dealt_to_several_tasks(spark, tmp_path):
    """Half of all rows are of one hour; each task that wrote rows of it has left a file."""
    days = "timestamp_ntz'1997-03-01 00:00:00' + make_dt_interval(if(id % 2 = 0, 0, cast(id % 4000 as int)))"
    columns = {
        "l_orderkey": "id", "l_partkey": "id % 200", "l_suppkey": "id % 10", "l_linenumber": "cast(if(id % 2 = 0, 1, id % 7 + 1) as int)", "l_quantity": "cast(id % 50 + 1 as double)",
        "l_extendedprice": "id * 1.5D", "l_discount": "0.05D", "l_tax": "0.02D", "l_returnflag": "'A'", "l_linestatus": "'O'", "l_shipdate": days,
    }
    items = spark.range(0, 40_000, 1, 8).selectExpr(*[f"{sql} as {c}" for c, sql in columns.items()])
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    key, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(key, "32k")
    try:
        stored = tables.TypedTables(spark, str(tmp_path))["impressions"]
    finally:
        spark.conf.set(key, before)
    files = [f for f in stored.inputFiles() if "dt=1997-01-01T01" in f]
    assert len(files) > 1
    derived = tables.Tables(spark, str(tmp_path))["impressions"]
    assert stored.select(derived.columns).exceptAll(derived).isEmpty() and stored.count() == derived.count()


def test_exact_cuts_sort_no_rows(spark, monkeypatch):
    plans = []

    def stored(df, name):
        plans.append(plan(df))
        return sinks.via_shared_table(df, name)

    monkeypatch.setattr(percentiles, "via_shared_table", stored)
    rows = spark.range(0, 20_000, 1, 4).selectExpr("id % 3 as k", "case when id % 10 = 0 then null else sqrt(id) - 70 end as x", "id % 5 - 2 as y")
    cuts = {r.k: r for r in percentiles.exact_cuts(rows, ["k"], {"x": "x", "y": "y"}, bins=16).collect()}
    assert len(plans) > 2 and not any("SortAggregate" in p for p in plans)
    for k in range(3):
        for axis in "xy":
            known = sorted(r[axis] for r in rows.where(f"k = {k} and {axis} is not null").collect())
            ranks = [math.ceil(len(known) * Fraction(str(p))) for p in percentiles.PROBABILITIES]
            assert cuts[k][axis] == [known[r - 1] for r in ranks]


def test_exact_sums_of_mixed_keys_are_gathered_first(spark):
    """No task of the first sum sends on nearly as many sums as it has read rows; one key holds half of all rows."""
    rows = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 2 = 0, null, id % 4001) as k", "id * 0.25D as x")
    parts = metrics.gathered(rows, ["k"]).groupBy("k", F.spark_partition_id()).count()
    assert parts.count() <= 4001 + 8 < rows.groupBy("k", F.spark_partition_id()).count().count()
    want = {r.k: r.x for r in rows.groupBy("k").agg(F.sum("x").alias("x")).collect()}
    sums = metrics.gathered(rows, ["k"]).groupBy("k").agg(F.expr(exact_sum("x")).alias("x"))
    assert {r.k: r.x for r in sums.collect()} == want


def test_repeated_crm_rows_are_attached_once(spark, monkeypatch):
    """200 equal CRM rows multiply the sums by 200, and the rows that the last sum reads by one."""
    met = []
    real = health.attach_all
    monkeypatch.setattr(health, "attach_all", lambda facts, steps: met.append(real(facts, steps)) or met[-1])

    def table(name, rows):
        if not rows:
            return spark.createDataFrame([], SCHEMAS[name])
        return reduce(DataFrame.unionByName, [spark.range(1).select(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]]) for r in rows])

    impression = {"at": 1704067200000, "dt": "2024-01-01T00", "bid__app_platform": "IOS", "bid__campaign_id": 1, "bid__customer_id": 1, "spend_micros": 1_000_001, "revenue_micros": 3}
    crm = {"campaign_id_18_digit__c": "a", "sales_region__c": "EMEA", "opportunity__c": "o", "dt": "2024-01-01"}
    given = {
        **dict.fromkeys(SCHEMAS, None),
        "impressions": [impression],
        "campaigns": [{"id": 1, "customer_id": 1, "state": "enabled", "salesforce_campaign_id": "a"}],
        "crm_opportunities": [{"opportunity_id_18_digit__c": "o", "scale_zone__c": "z", "dt": "2024-01-01"}],
    }
    filled = {name: table(name, rows) for name, rows in given.items()}
    once = table("crm_campaigns", [crm])
    filled["crm_campaigns"] = once.crossJoin(spark.range(200)).drop("id").unionByName(once.withColumn("sales_region__c", F.lit("NA")))
    for exact in (False, True):
        report = health.platform_health_v2(filled, "2024-01-01T00", as_of="timestamp'2024-01-01 12:00:00'", exact=exact).collect()
        assert {r.campaign_sales_region: r.impressions for r in report} == {"EMEA": 200, "NA": 1}
        assert {r.campaign_sales_region: round(r.internal_spend, 6) for r in report} == {"EMEA": 200.0002, "NA": 1.000001}
        assert met[-1].count() == 2


def shuffle_files(spark):
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for top in places for _, _, names in os.walk(str(top)) for name in names if name.startswith("shuffle_")}


def test_shuffle_files_of_stored_results_go_at_once(spark):
    rows = spark.range(0, 20_000, 1, 4).groupBy((F.col("id") % 5000).alias("k")).count()
    before = shuffle_files(spark)
    with sinks.shuffles_released(spark):
        stored = sinks.via_shared_table(rows, "released")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and stored.count() == 5000
    assert spark.conf.get(sinks._CLEANUP) == "false"


def test_several_large_dimensions_move_the_facts_once(spark, monkeypatch):
    """Three of them, no broadcast: sums are stored once, dealt out once, and summed again where they are. Null ids,
    repeated dimension rows, and a pair of ids that holds half of the facts."""
    facts = spark.range(0, 20_000, 1, 4).selectExpr("if(id % 2 = 0, 7, if(id % 11 = 0, null, id % 50)) as a", "if(id % 2 = 0, 3, if(id % 13 = 0, null, id % 30)) as b", "id % 4 as c", "id as x", "1L as n")
    sides = [spark.range(45).selectExpr("id as key", f"if(id % 9 = 0, null, concat('{name}', id)) as named") for name in "abc"]
    sides[1] = sides[1].unionByName(sides[1].where("key = 3")).unionByName(sides[1].where("key = 5").withColumn("named", F.lit("other")))
    steps = [(side, {on: "key"}, {"named": f"{on}_name"}) for on, side in zip("abc", sides)]
    keys = ["a", "b", "c", "x", "a_name", "b_name", "c_name"]
    plain = reduce(lambda df, step: dimensions.attach(df, *step), steps, facts)
    want = sorted(map(str, plain.groupBy(*keys).agg(F.sum("n").alias("n")).collect()))
    stored = []
    real = dimensions.via_shared_table
    monkeypatch.setattr(dimensions, "via_shared_table", lambda df, name, **more: stored.append(name) or real(df, name, **more))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = dimensions.attach_all(facts, steps)
        dealt = [c for c in dimensions.DEALT if c in joined.columns]
        sums = joined.groupBy(*dealt, *keys).agg(F.sum("n").alias("n")).drop(*dealt)
        assert stored.count("sums") == 1
        assert len(re.findall(r"Exchange hashpartitioning", plan(sums))) == 2  # of facts, and of what is known of their ids
        assert sorted(map(str, sums.collect())) == want
        tasks = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
