"""Whole jobs on hand-made rows, sinks, and the shape of plans."""

import re

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import buckets, dimensions, funnel
from funnelspark.operators.metrics import METRICS
from funnelspark.plans import bid_validation, platform_health_v1, platform_health_v2, revenue_calibration
from funnelspark.sources import SCHEMAS, flatten_records, latest_partition, open_table, read_table

HOUR = "2024-01-10T05"
AT = 1704862800000 + 600_000  # 05:10 of that hour
H = 3_600_000
AS_OF = "timestamp'2024-01-10 12:00:00'"


def table(spark, name, *rows):
    schema = SCHEMAS[name]
    filled = [tuple(r.get(f.name) for f in schema) for r in rows]
    return spark.createDataFrame(filled, schema)


def bid(prefix="", **more):
    base = {
        "app_platform": "IOS", "ad_group_type": "user-acquisition", "creative__type": "VAST", "creative__ad_format": "video",
        "bid_request__exchange": "UNITY", "customer_id": 7, "app_id": 70, "campaign_id": 1, "ad_group_id": 100,
        "price_data__model_type": "revenue-v3", "price_data__conversion_likelihood": 3e6,
        "price_data__compensated_margin_bid_multiplier": 0.5, "auction_result__winner__price_cpm_micros": 2_000_000,
        "price_cpm_micros": 3_000_000,
    }
    return {f"{prefix}bid__{k}": v for k, v in {**base, **more}.items()}


def make_tables(spark, **rows):
    names = [
        "impressions", "ad_clicks", "view_clicks", "matched_installs", "unmatched_installs", "matched_app_events",
        "unmatched_app_events", "campaigns", "goals", "treasurer_configs", "customers", "trackers", "apps", "ad_groups",
        "campaign_types", "crm_campaigns", "crm_opportunities",
    ]
    return {n: table(spark, n, *rows.get(n, [])) for n in names}


@pytest.fixture(scope="module")
def tables(spark):
    install = {"event_timestamp": AT, "for_reporting": True, "is_uncredited": False, "is_viewthrough": True, "dt": HOUR}
    event = {**install, "customer_revenue_micros": 5_000_000, "custom_event_id": 4, "first_occurrence": True}
    chain = bid("install__ad_click__impression__")
    return make_tables(
        spark,
        impressions=[
            {"at": AT, "dt": HOUR, "spend_micros": 10, "revenue_micros": 20, **bid()},
            {"at": AT, "dt": HOUR, "spend_micros": 10, "revenue_micros": 20, **bid(app_platform="UNKNOWN")},
            {"at": AT, "dt": "2024-01-10T06", "spend_micros": 10, "revenue_micros": 20, **bid()},
        ],
        ad_clicks=[
            {"at": AT, "impression__at": AT, "dt": HOUR, "has_prior_click": flag, **bid("impression__")}
            for flag in (True, False, None)
        ],
        view_clicks=[{"at": AT, "impression__at": AT, "dt": HOUR, "has_prior_click": False, **bid("impression__")}],
        matched_installs=[
            {**install, "is_uncredited": flag, "ad_click__at": AT, **bid("ad_click__impression__")} for flag in (True, False, None)
        ],
        unmatched_installs=[{**install, "tracker_params__campaign_id": 1, "tracker_params__platform": "IOS"}],
        matched_app_events=[
            {**event, "install__at": AT - gap * H, **chain} for gap in (-1, 0, 167, 168)
        ] + [{**event, "install__at": None, **chain}],
        unmatched_app_events=[{**event, "install__at": AT, "tracker_params__campaign_id": 99}],
        campaigns=[
            {"id": 1, "customer_id": 7, "app_id": 70, "tracker_id": 1, "campaign_type_id": 2, "cpa_target_event_id": 4,
             "display_name": "camp", "state": "enabled", "salesforce_campaign_id": "c1", "vt_cap": 1.0}
        ],
        trackers=[{"id": 1, "name": "apple-skan"}],
        campaign_types=[{"id": 2, "name": "brand"}],
        customers=[{"id": 7, "company": "Acme"}],
        apps=[{"id": 70, "customer_id": 7, "display_name": "app", "category": "games", "video_viewthrough_enabled": True}],
        # Two CRM rows for one campaign: measures double, as a plain join does.
        crm_campaigns=[
            {"campaign_id_18_digit__c": "c1", "service_level__c": "gold", "sales_region__c": r, "opportunity__c": "o1", "dt": "2024-01-09"}
            for r in ("EU", "EU")
        ],
        crm_opportunities=[{"opportunity_id_18_digit__c": "o1", "scale_zone__c": "z", "dt": "2024-01-09"}],
        goals=[{"campaign_id": 1, "priority": 1, "type": "cpa", "target_value": 2.5}],
        treasurer_configs=[{"campaign_id": 1, "target": 0.25}],
        ad_groups=[{"id": 100, "display_name": "group", "bid_type": "cpr", "exploratory": True}],
    )


@pytest.fixture(scope="module")
def segments(spark):
    cuts = spark.createDataFrame(
        [("IOS", "revenue", "UNITY", "VAST", [1e6 * i for i in range(1, 12)], [float(i) for i in range(1, 12)], [0.5 * i for i in range(1, 12)])],
        "platform string, model_type string, exchange_group string, ad_format_group string, a array<double>, b array<double>, c array<double>",
    )
    return cuts.selectExpr(
        "platform", "model_type", "exchange_group", "ad_format_group",
        f"{buckets.intervals('a')} as convx", f"{buckets.intervals('b')} as private_cpm", f"{buckets.intervals('c')} as cpm",
    )


def total(rows, metric):
    return sum(r[metric] or 0 for r in rows)


def test_health_v1(tables, segments):
    report = platform_health_v1(tables, segments, HOUR, as_of=AS_OF)
    assert len(report.columns) == 44 + 19
    rows = report.collect()
    # Bucketless impression and the next hour are gone; CRM duplicates double campaign 1.
    assert total(rows, "impressions") == 2
    assert total(rows, "clicks") == 4
    assert total(rows, "installs") == 4
    matched = [r for r in rows if r.exchange_group == "UNITY"]
    assert {(r.convx_percentile, r.convx_percentile_low, r.convx_percentile_high) for r in matched} == {("30-40", 3.0, 4.0)}
    assert {(r.private_cpm_percentile, r.private_cpm_percentile_low) for r in matched} == {("40-50", 4.0)}
    assert {(r.cpm_percentile, r.cpm_percentile_low) for r in matched} == {("60-70", 3.0)}
    unmatched = [r for r in rows if r.exchange_group == "UNMATCHED"]
    assert all(r.convx_percentile is None and r.creative_type == "UNMATCHED" for r in unmatched)
    # -1 h, 0 h and 167 h after the install count; 168 h and no install do not; all doubled.
    assert total(matched, "target_events_d7") == 6
    assert total(matched, "customer_revenue_d7") == 30.0
    assert {r.campaign_tracker_type for r in rows} == {"SKAN", "MMP"}
    named = next(r for r in matched if r.impressions)
    assert (named.customer_name, named.dest_app_name, named.campaign_name, named.service_level) == ("Acme", "app", "camp", "gold")
    assert (named.goal_type_3, named.treasurer_target, named.ad_group_bid_type, named.campaign_tracker) == ("cpa", 0.25, "cpr", "apple-skan")
    assert named.viewthrough_enabled and named.is_enrolled_in_vio and named.exploratory_ad_group
    assert named.impression_at == named["at"] == "2024-01-10T05:00:00Z" and named.click_at is None
    assert named.private_value == 2 * 4.0 and named.predicted_conversion_likelihood == 2 * 3.0
    assert named.predicted_clicks is None and named.predicted_installs_ct == 0


def test_health_v2(tables):
    report = platform_health_v2(tables, HOUR, as_of=AS_OF)
    assert len(report.columns) == 28 + 19 and "click_at" not in report.columns
    rows = report.collect()
    assert total(rows, "impressions") == 4  # no bucket is needed here
    assert {r.scale_zone for r in rows if r.campaign_id == 1} == {"z"}
    assert {(r.dest_app_category, r.campaign_type) for r in rows if r.impressions} == {("games", "brand")}
    assert total(rows, "customer_revenue_d7") == 30.0 + 5.0


def test_hour_range_of_reports_adds_up(tables):
    """Two hours in one run hold the sums of two runs."""
    both = platform_health_v2(tables, HOUR, "2024-01-10T07", AS_OF).collect()
    parts = platform_health_v2(tables, HOUR, as_of=AS_OF).collect() + platform_health_v2(tables, "2024-01-10T06", as_of=AS_OF).collect()
    for metric in METRICS:
        assert total(both, metric) == pytest.approx(total(parts, metric))


def test_funnel_keeps_sources_apart(tables):
    """Ad and view clicks with equal keys stay two rows, as a bag union of two sums."""
    rows = [r for r in funnel.funnel(tables, HOUR, "2024-01-10T06", "v2").collect() if r.clicks]
    assert [r.clicks for r in rows] == [1, 1]
    assert len(funnel.key_names("v1")) == 27 and len(funnel.key_names("v2")) == 15


def above_union(report):
    """Names of the operators between the result and the union of the sources, nearest the result first."""
    lines = report._jdf.queryExecution().executedPlan().treeString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    at = min(i for i, line in enumerate(lines) if re.search(r"\bUnion\b", line))
    path, d = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < d:
            path.append(lines[i].strip(" :+-*()0123456789"))
            d = depth[i]
    return path[::-1]


@pytest.fixture(scope="module")
def stored(spark, tables, segments, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    for name, df in {**tables, "segments": segments}.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in [*tables, "segments"]}


def test_exchanges_of_facts_are_few(spark, stored):
    """One with small dimensions."""
    for report in (platform_health_v2(stored, HOUR, as_of=AS_OF), platform_health_v1(stored, stored["segments"], HOUR, as_of=AS_OF)):
        path = above_union(report)
        assert sum(x.startswith("Exchange") for x in path) == 1
        assert sum("Join" in x for x in path) <= 5


def test_large_dimensions_are_attached_to_stored_sums(spark, stored):
    """Without broadcast of any: one exchange for the last of the dimensions and one for the last sum; same rows."""
    reports = lambda: (platform_health_v2(stored, HOUR, as_of=AS_OF), platform_health_v1(stored, stored["segments"], HOUR, as_of=AS_OF))
    want = [sorted(map(str, r.collect())) for r in reports()]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report, rows in zip(reports(), want):
            plan = report._jdf.queryExecution().executedPlan().toString()
            assert "Union" not in plan and plan.count("SortMergeJoin") <= 2
            assert not re.search(r"Exchange hashpartitioning\(_(tracker|type)_id", plan)
            assert sorted(map(str, report.collect())) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_report_with_half_of_its_rows_in_one_campaign(spark, stored, tmp_path):
    """No broadcast: no task of the last joins, or of the sum after them, gets over twice the rows of the median."""
    rows = spark.range(24_000).selectExpr(
        f"{AT} + id % 7 * 0 as at", f"'{HOUR}' as dt", "'IOS' as bid__app_platform", "if(id % 2 = 0, 1, id % 1500) as bid__campaign_id",
        "if(id % 2 = 0, 7, id % 400) as bid__customer_id", "if(id % 2 = 0, 70, id % 700) as bid__app_id", "id % 900 as bid__ad_group_id",
        "concat('t', id % 997) as bid__creative__type", "10L as spend_micros", "20L as revenue_micros",
    )
    given = {f.name: f.dataType for f in SCHEMAS["impressions"]}
    rows = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in given.items()])
    ids = spark.range(1500)
    more = {
        "campaigns": ids.selectExpr("id", "concat('c', id) as display_name", "id % 5 as tracker_id", "id as vt_cap"),
        "customers": ids.selectExpr("id", "concat('k', id) as company"),
        "apps": ids.selectExpr("id", "id % 400 as customer_id", "concat('a', id) as display_name"),
    }
    filled = dict(stored)
    for name, df in {"impressions": rows, **more}.items():
        kinds = {f.name: f.dataType for f in SCHEMAS[name]}
        df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]).write.parquet(f"{tmp_path}/{name}")
        filled[name] = spark.read.parquet(f"{tmp_path}/{name}")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    want = sorted(map(str, platform_health_v2(filled, HOUR, as_of=AS_OF).collect()))
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    read = []
    try:
        real = dimensions.attach_spread

        def spread(*arguments):
            joined = real(*arguments)
            read.append([r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()])
            return joined

        with pytest.MonkeyPatch.context() as m:
            m.setattr(dimensions, "attach_spread", spread)
            report = platform_health_v2(filled, HOUR, as_of=AS_OF)
        assert sorted(map(str, report.collect())) == want and len(want) > 10_000
        read.append([r.n for r in report.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(read) >= 4
    for tasks in read:
        assert len(tasks) == 8 and max(tasks) <= 2 * sorted(tasks)[4]


def test_spread_is_a_left_join(spark):
    """Null keys, repeated and missing dimension rows, a heavy key; as a plain left join."""
    facts = spark.range(3000).selectExpr("if(id % 3 = 0, 5, if(id % 7 = 0, null, id % 40)) as k", "id % 2 as j", "id as x")
    side = spark.range(60).selectExpr("id % 30 as a", "id % 2 as b", "id as name")
    on, take = {"k": "a", "j": "b"}, {"name": "name"}
    want = sorted(map(str, dimensions.attach(facts, side, on, take).collect()))
    for parts in (2, 10, 1000):
        assert sorted(map(str, dimensions.attach_spread(facts, side, on, take, parts).collect())) == want
    assert dimensions.heavy_keys(facts, ["k"], 10).collect() == [(5, 4)]
    assert sorted(map(str, dimensions.attach_spread(facts.limit(0), side, on, take).collect())) == []


def test_reports_prune_all_sources(spark, tables, segments, tmp_path):
    """Every source and both snapshots are read by partition."""
    root, parted = str(tmp_path), [n for n in tables if "dt" in tables[n].columns]
    for name in parted:
        tables[name].write.partitionBy("dt").parquet(f"{root}/{name}")
    read = {**tables, **{n: read_table(spark, root, n) for n in parted}}
    report = platform_health_v2(read, HOUR, as_of=AS_OF)
    plan = report._jdf.queryExecution().executedPlan().toString()
    crm = dimensions.crm_campaign_v2(read["crm_campaigns"], read["crm_opportunities"], tables["campaigns"], AS_OF)
    crm_plan = crm._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in re.findall(r"FileScan parquet .*", plan) if not re.search("/(crm-)?campaigns-|/dimension-", x)]
    assert len(parted) == 9 and len(scans) == 7 and crm_plan.count("FileScan") >= 2
    assert all(re.search(r"PartitionFilters: \[[^\]]*dt#", x) for x in [*scans, *re.findall(r"FileScan parquet .*", crm_plan)])
    assert total(report.collect(), "impressions") == 4


def test_tables_by_partition_list_only_what_is_asked_for(spark, tables, segments, tmp_path):
    """Same rows as through whole tables; no file scan to find a snapshot, and none of other hours' files."""
    root, parted = str(tmp_path), [n for n in tables if "dt" in tables[n].columns]
    for name in parted:
        tables[name].write.partitionBy("dt").parquet(f"{root}/{name}")
    read = {**tables, **{n: open_table(spark, root, n) for n in parted}}
    crm = read["crm_campaigns"]
    assert "Scan parquet" not in latest_partition(crm.listed(), 4, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert crm.newest(4, AS_OF).select("dt").distinct().count() == 1 and crm.newest(0, "timestamp'2030-01-01'").count() == 0
    newest = crm.newest(4, AS_OF)
    assert newest.schema == read_table(spark, root, "crm_campaigns").schema and len({f.rsplit("/", 2)[1] for f in newest.inputFiles()}) == 1
    assert read["impressions"].hours("2000-01-01T00", "2001-01-01T00").count() == 0
    hours = read["impressions"].partitions()
    files = read["impressions"].hours(hours[0], hours[0], "both").inputFiles()
    assert files and all(f"dt={hours[0]}/" in f for f in files)
    for report in (platform_health_v1, platform_health_v2):
        extra = (segments,) if report is platform_health_v1 else ()
        got = report(read, *extra, HOUR, as_of=AS_OF).collect()
        assert sorted(map(str, got)) == sorted(map(str, report(tables, *extra, HOUR, as_of=AS_OF).collect()))


def test_common_expressions_are_stated_once(spark, tables, segments):
    """Above the unions, in this plan alone: no rule is switched off for the session."""
    assert spark.conf.get("spark.sql.optimizer.excludedRules", "") == ""
    plans = [platform_health_v1(tables, segments, HOUR, as_of=AS_OF), platform_health_v2(tables, HOUR, as_of=AS_OF)]
    for report, unions in zip(plans, (2, 1)):
        text = report._jdf.queryExecution().optimizedPlan().toString()
        below = text[text.index("Union") :]
        assert text.count("CASE WHEN (creative__ad_format") == 0 and below.count("UNMATCHED") >= 1
        # The five formats of P-06 are told apart once for each union.
        assert text.count("html-interstitial") <= 2 * unions


def test_hot_campaign_is_split(spark):
    """Half of the rows in one campaign, no broadcast: the partition is split when the join is the last on its key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(200000).selectExpr("if(id % 2 = 0, 7, id % 1000) as campaign_id", "id as x").repartition(8, "x")
        campaigns = spark.range(1000).selectExpr("id", "concat('c', id) as display_name", "id % 5 as tracker_id")
        trackers = spark.range(5).selectExpr("id", "concat('t', id) as name")
        campaign = dimensions.campaign_dimension(
            campaigns, [(trackers, {"_tracker_id": "id"}, {"name": "_tracker"})], {"display_name": "_name", "tracker_id": "_tracker_id"}
        )
        joined = dimensions.attach(facts, campaign, {"campaign_id": "campaign_id"}, {"_tracker": "_tracker"})
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_exact_reports_agree_to_the_last_bit(spark, tables, segments):
    """However the impressions are dealt to tasks."""
    r = tables["impressions"].where("bid__campaign_id = 1").limit(1)
    many = r.drop("bid__price_data__conversion_likelihood").crossJoin(spark.range(3000).selectExpr("(hash(id) % 1000 / 7D) * pow(10, id % 9) as bid__price_data__conversion_likelihood")).select(*r.columns)
    many = spark.createDataFrame(many.collect(), many.schema)
    runs = set()
    for parts in (1, 5, 16):
        report = platform_health_v2({**tables, "impressions": many.repartition(parts)}, HOUR, as_of=AS_OF, exact=True)
        runs.add(tuple(sorted(repr(x) for x in report.collect())))
    assert len(runs) == 1


def test_funnel_needs_segments_in_v1(tables):
    with pytest.raises(ValueError):
        funnel.funnel_rows(tables, HOUR, HOUR, "v1")


def test_calibration_equals_row_by_row_join(spark):
    """Keys repeated on both sides, nulls, NaN and infinities, buckets outside the window."""
    day = "2024-01-0{}"
    results = spark.createDataFrame(
        [(day.format(d), [1, 2], 5, p, s, 1.0, b) for d in (1, 2, 9) for p in (1e6, float("nan"), float("inf"), None) for s, b in ((2e6, 1.0), (None, 1.0), (4e6, None))],
        "d string, ab_test_group_ids array<bigint>, ad_group_id bigint, predicted_revenue_micros double, suggested_revenue_micros double, planned_revenue_micros double, suggested_bid_target_micros double",
    ).selectExpr("cast(d as timestamp) as time_bucket", "* except (d)")
    history = spark.createDataFrame(
        [(day.format(d), [1, 2], 5, 3_000_000, t, e, True) for d in (1, 2, 9) for t, e in ((1, True), (2, True), (0, True), (1, None), (1, False))],
        "d string, ab_test_group_ids array<bigint>, ad_group_id bigint, revenue_micros bigint, bid_target_micros bigint, enabled boolean, estimated boolean",
    ).selectExpr("cast(d as timestamp) as time_bucket", "* except (d)")
    now = "timestamp'2024-01-03 00:30:00'"
    got = revenue_calibration(results, history, "interval '2' day", now).collect()
    # Only 2024-01-02 is inside (the other day is too old, the third in the future):
    # 8 usable results x 2 usable history rows.
    assert [(str(r.time), r.revenue, r.predicted_revenue, r.suggested_revenue, r.planned_revenue) for r in got] == [
        ("2024-01-02 00:00:00", 48.0, 4.0, 16.0, 16e-6)
    ]
    with pytest.raises(ValueError):
        revenue_calibration(results, history.drop("bid_target_micros"), "interval '2' day", now)


def test_bid_validation(spark, tables):
    out = bid_validation(tables["impressions"], tables["ad_groups"], HOUR, "2024-01-10T06", [100])
    assert out.count() == 3  # both ends of the range are inside
    row = out.first()
    assert (row.p_cvr, row.private_value, row.nrm_by_cal, row.margin_multiplier) == (3.0, 0.004, 0.5, 0.5)
    assert bid_validation(tables["impressions"], tables["ad_groups"], HOUR, HOUR, [1]).count() == 0
    assert bid_validation(tables["impressions"], tables["ad_groups"], HOUR, HOUR, limit=1).count() == 1


def test_hour_scan_reads_only_its_partitions_and_columns(spark, tmp_path, tables):
    tables["impressions"].write.partitionBy("dt").parquet(str(tmp_path / "impressions"))
    read = {**tables, "impressions": read_table(spark, str(tmp_path), "impressions")}
    assert read["impressions"].schema["dt"].dataType.simpleString() == "string"
    report = platform_health_v2(read, HOUR, as_of=AS_OF)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ >= 2024-01-10T05\)", plan)
    assert total(report.collect(), "impressions") == 4


def test_flatten_records(spark):
    df = spark.sql("select 1 as a, named_struct('x', 2, 'y', named_struct('z', 3)) as b, array(1) as c")
    flat = flatten_records(df)
    assert flat.columns == ["a", "b__x", "b__y__z", "c"]
    assert tuple(flat.first())[:3] == (1, 2, 3)


def test_events_of_segments_with_equal_edges_are_one_row(spark, tables, segments):
    """App events of two segments whose report keys agree, dimensions broadcast and not: sums by place are put together."""
    event = {"event_timestamp": AT, "install__at": AT, "for_reporting": True, "is_uncredited": False, "dt": HOUR, "customer_revenue_micros": 5_000_000}
    origin = bid("install__ad_click__impression__", bid_request__exchange="SMALL_ONE")
    events = [{**event, **origin, **bid("attribution_event__click__impression__", bid_request__exchange=x)} for x in ("UNITY", "VUNGLE", "VUNGLE")]
    given = make_tables(spark, matched_app_events=events)
    given = {**tables, **{n: given[n] for n in given if "for_reporting" in given[n].columns or "has_prior_click" in given[n].columns or n == "impressions"}}
    both = segments.unionByName(segments.withColumn("exchange_group", F.lit("VUNGLE")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            for exact in (False, True):
                found.append(platform_health_v1(given, both, HOUR, as_of=AS_OF, exact=exact).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all(rows == found[0] for rows in found)
    assert [(r.customer_revenue_d7, r.convx_percentile, r.convx_percentile_low, r.cpm_percentile_high) for r in found[0]] == [(30.0, "30-40", 3.0, 3.5)]


def test_sums_are_stored_and_moved_without_names_of_buckets(spark, stored, monkeypatch):
    kept = {}
    real = dimensions.via_shared_table

    def keep(df, name, **more):
        kept[name] = real(df, name, **more)
        return kept[name]

    monkeypatch.setattr(dimensions, "via_shared_table", keep)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        platform_health_v1(stored, stored["segments"], HOUR, as_of=AS_OF)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert set(funnel.BUCKET_PLACES) < set(kept["sums"].columns) and not set(funnel.BUCKET_KEYS) & set(kept["sums"].columns)
    assert not set(METRICS) & set(kept["known"].columns)
