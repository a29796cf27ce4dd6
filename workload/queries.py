"""One query per operator, each over whole tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark import functions as fx
from funnelspark.operators import buckets, dimensions, funnel, metrics, percentiles
from funnelspark.plans import (
    bid_validation,
    daily_sketches_v1,
    daily_sketches_v2,
    platform_health_v1,
    platform_health_v2,
    prediction_bucket_v1,
    prediction_bucket_v2,
    revenue_calibration,
    stored_segments_v1,
    stored_segments_v2,
    train_segments_v1,
    train_segments_v2,
)
from funnelspark.plans import bucket_tables
from funnelspark.plans.bucket_tables import AXES_V1, AXES_V2, KEYS_V1, KEYS_V2
from funnelspark.sources import PartitionedTable, read_table, recover, shared_folder, via_shared_table, write_hour, write_hours, write_once
from funnelspark.sources.sinks import PLAN, Files
from workload.tables import ListedTables, Tables, TypedTables

Query = Callable[[SparkSession, str], DataFrame]

# Wide enough for every row; the hour range is a parameter of the jobs.
START, END = "1990-01-01T00", "2100-01-01T00"
AS_OF = "2024-01-30 12:00:00"
NOW = f"timestamp'{AS_OF}'"
CALIBRATION_AS_OF = "2001-12-01 00:00:00"
CALIBRATION_DAYS = 4000
# An hour of impressions, an hour and a week of the other events, a training window whose first hour and
# first day are cut, and what a bid check is asked for.
IMPRESSION_HOUR = "1997-01-01T01"
EVENT_HOUR = "2024-01-12T23"
WEEK = ("2024-01-05T00", "2024-01-12T00")
TRAINING = ("1996-01-01T01", "1999-01-01T02")
#: A training window of whole days, merged from stored sketches.
SKETCHED = ("1997-01-01T00", "1997-01-15T00")
#: Start, the hour left without rows, and end of a backfill.
BACKFILL = ("2024-01-12T21", "2024-01-12T22", "2024-01-13T00")
CHECKED_HOURS = ("1997-01-01T00", "1997-01-01T01")
CHECKED_IDS = (1, 3, 5)

QUERIES: dict[str, Query] = {}


def query(f: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(Tables(spark, folder))

    QUERIES[f.__name__] = run
    return run


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Double sums depend on the order of addition in their last bits; compare them rounded."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def metric_digits(name: str) -> int:
    """Decimals a metric is compared to: more than its terms have, fewer than a double loses."""
    if "_micros_" in name:
        return 7 if name.endswith("_vt") else 6
    return 9


def large_sum_digits(name: str) -> int:
    """The same for sums over thousands of rows."""
    return 3 if "_micros_" in name else 7


def rounded_metrics(df: DataFrame) -> DataFrame:
    sums = {m for m in metrics.METRICS if dict(df.dtypes)[m] == "double"}
    return df.select(
        *[F.round(c, metric_digits(c)).alias(c) if c in sums else F.col(c) for c in df.columns]
    )


def counted(df: DataFrame, keys: dict[str, str] | list[str], **more: str) -> DataFrame:
    """Rows per key, the keys given as expressions."""
    named = keys if isinstance(keys, dict) else {k: k for k in keys}
    return df.groupBy(*[F.expr(sql).alias(k) for k, sql in named.items()]).agg(
        F.count("*").alias("n"), *[F.expr(sql).alias(name) for name, sql in more.items()]
    )


# --- scans, predicates, scalar functions ---------------------------------------------------


@query
def hour_range_scan(t: Tables) -> DataFrame:
    """Rows per platform inside the same bounds, under each choice of open and closed ends."""
    tests = {
        **{
            f"n_{closed}": fx.hour_range("dt", "1997-01-01T01", "2000-01-01T03", closed)
            for closed in ("left", "right", "both", "neither")
        },
        "n_day_open": fx.day_range("at", "1997-01-01T00", "2000-01-01T00", "neither"),
        "n_day_shifted": fx.day_range("at", "1997-01-01T05", "2000-01-01T05", "both"),
    }
    sums = [F.expr(f"count_if({sql})").alias(name) for name, sql in tests.items()]
    return t["impressions"].groupBy(F.col("bid__app_platform").alias("platform")).agg(*sums)


@query
def iso_hour_counts(t: Tables) -> DataFrame:
    hours = counted(t["matched_app_events"], {"hour": fx.hour_ms("event_timestamp")})
    return hours.selectExpr(f"{fx.iso_text('hour')} as hour", f"{fx.iso_day('hour')} as day", "n")


@query
def recode_dims(t: Tables) -> DataFrame:
    fmt = "bid__creative__ad_format"
    return counted(
        t["impressions"],
        {
            "exchange_group": fx.exchange_group("bid__bid_request__exchange"),
            "country_group": fx.country_group("bid__bid_request__device__geo__country"),
            "ad_format": fx.ad_format(fmt),
            "ad_format_group": fx.ad_format_group(fmt),
            "model_type": fx.model_type("bid__price_data__model_type"),
        },
    )


@query
def bid_economics(t: Tables) -> DataFrame:
    """Row-level bid validation for every ad group and hour."""
    return bid_validation(t["impressions"], t["ad_groups"], START, END)


# --- aggregates ----------------------------------------------------------------------------


def _predicted(t: Tables, variant: str) -> DataFrame:
    keys = ["bid__campaign_id", "bid__app_platform", "bid__ad_group_type", "bid__creative__type"]
    sums = t["impressions"].groupBy(*keys).agg(*metrics.predicted_metrics(variant))
    return sums.select(
        *keys, *[F.round(c, large_sum_digits(c)).alias(c) for c in metrics.predicted_terms(variant)]
    )


@query
def predicted_metrics_v1(t: Tables) -> DataFrame:
    return _predicted(t, "v1")


@query
def predicted_metrics_v2(t: Tables) -> DataFrame:
    return _predicted(t, "v2")


@query
def finite_sum(t: Tables) -> DataFrame:
    value = "predicted_revenue_micros"
    sums = counted(
        t["ad_group_results"],
        ["ad_group_id"],
        finite_revenue=metrics.sum_finite(value),
        n_special=f"count_if({fx.is_special(value)})",
    )
    return rounded(sums, 2)


@query
def finite_sum_exact(t: Tables) -> DataFrame:
    """The same sum to the last bit."""
    return counted(t["ad_group_results"], ["ad_group_id"], finite_revenue=metrics.sum_finite("predicted_revenue_micros", exact=True))


def _predicted_exact(t: Tables, variant: str) -> DataFrame:
    keys = ["bid__campaign_id", "bid__app_platform", "bid__ad_group_type", "bid__creative__type"]
    terms = t["impressions"].selectExpr(*keys, *[f"{sql} as {name}" for name, sql in metrics.predicted_terms(variant).items()])
    return metrics.gathered(terms, keys).groupBy(*keys).agg(*metrics.predicted_metrics(variant, exact=True))


@query
def predicted_metrics_exact_v1(t: Tables) -> DataFrame:
    """Price and prediction sums to the last bit."""
    return _predicted_exact(t, "v1")


@query
def predicted_metrics_exact_v2(t: Tables) -> DataFrame:
    return _predicted_exact(t, "v2")


@query
def clamp_revenue(t: Tables) -> DataFrame:
    return counted(
        t["matched_app_events"],
        ["custom_event_id", "is_viewthrough"],
        revenue_micros=f"sum({metrics.revenue_micros('customer_revenue_micros')})",
    )


@query
def cohort_d7(t: Tables) -> DataFrame:
    """Order quantity gated by the time from order to shipment, shipments before the order included."""

    def ms(column: str) -> str:
        return f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', {column})"

    inside = fx.in_cohort(fx.hour_ms(ms("l_shipdate")), fx.hour_ms(ms("o_orderdate")), 7)
    return counted(
        t["lineitem"].join(t["orders"], F.expr("l_orderkey = o_orderkey"), "left"),
        ["l_returnflag", "l_linestatus", "o_orderpriority"],
        quantity_d7=f"sum({metrics.cohort_value('cast(l_quantity as bigint)', inside)})",
        n_inside=f"count_if({inside})",
    )


@query
def two_level_agg(t: Tables) -> DataFrame:
    """Sums per fine key, then per coarse key with a dimension attached."""
    fine = counted(
        t["lineitem"],
        ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"],
        quantity="sum(cast(l_quantity as bigint))",
    )
    named = dimensions.attach(fine, t["supplier"], {"l_suppkey": "s_suppkey"}, {"s_nationkey": "nation"})
    return named.groupBy("nation", "l_returnflag", "l_linestatus").agg(
        F.sum("quantity").alias("quantity"), F.sum("n").alias("n")
    )


# --- snapshots and dimensions --------------------------------------------------------------


@query
def latest_snapshot(t: Tables) -> DataFrame:
    """Newest CRM day within two days, and its rows per service level; nothing within zero days.

    The day is found among partition names, and only its folder is opened.
    """
    crm = listed(t)["crm_campaigns"]

    def rows(days: int) -> DataFrame:
        return crm.newest(days, NOW).groupBy("dt", "service_level__c").agg(F.count("*").alias("n")).withColumn("days", F.lit(days))

    return rows(2).unionByName(rows(20)).unionByName(rows(0))


@query
def primary_goal(t: Tables) -> DataFrame:
    return dimensions.primary_goal(t["goals"])


@query
def crm_campaigns_v1(t: Tables) -> DataFrame:
    return dimensions.crm_campaign_v1(t["crm_campaigns"], t["campaigns"], NOW)


@query
def crm_campaigns_v2(t: Tables) -> DataFrame:
    return dimensions.crm_campaign_v2(t["crm_campaigns"], t["crm_opportunities"], t["campaigns"], NOW)


@query
def repeated_dimension_keys(t: Tables) -> DataFrame:
    """Campaigns that the CRM join would fan out."""
    crm = dimensions.crm_campaign_v1(t["crm_campaigns"], t["campaigns"], NOW)
    return dimensions.repeated_keys(crm, ["campaign_id"])


@query
def star_enrich(t: Tables) -> DataFrame:
    """Clicks with app, campaign, tracker (through the campaign) and ad group attached."""
    bid = "impression__bid__"
    f = t["ad_clicks"].selectExpr(
        f"{bid}campaign_id as campaign_id",
        f"{bid}app_id as app_id",
        f"{bid}customer_id as customer_id",
        f"{bid}ad_group_id as ad_group_id",
        f"{bid}creative__type as creative_type",
        f"{fx.ad_format(f'{bid}creative__ad_format')} as ad_format",
    )
    campaign = {"display_name": "campaign_name", "tracker_id": "tracker_id", "vt_cap": "vt_cap"}
    f = dimensions.attach(f, t["campaigns"], {"campaign_id": "id"}, campaign)
    f = dimensions.attach(f, t["trackers"], {"tracker_id": "id"}, {"name": "tracker"})
    flags = {f"{k}_viewthrough_enabled": k for k in ("video", "banner", "interstitial", "native")}
    f = dimensions.attach(
        f, t["apps"], {"app_id": "id", "customer_id": "customer_id"}, {"display_name": "app_name", **flags}
    )
    f = dimensions.attach(f, t["ad_groups"], {"ad_group_id": "id"}, {"exploratory": "exploratory"})
    return counted(
        f,
        {
            "campaign_name": "campaign_name",
            "app_name": "app_name",
            "exploratory": "exploratory",
            "campaign_tracker": fx.name_or_na("tracker"),
            "campaign_tracker_type": fx.tracker_type("tracker", "campaign_id"),
            "is_enrolled_in_vio": fx.vio_enrolled("vt_cap"),
            "viewthrough_enabled": fx.viewthrough_enabled("creative_type", "ad_format", *flags.values()),
        },
    )


@query
def null_rejecting_join(t: Tables) -> DataFrame:
    """An outer join whose filter on the right side makes it inner."""
    joined = t["orders"].join(t["lineitem"], F.expr("o_orderkey = l_orderkey"), "left")
    kept = joined.where("l_returnflag = 'R' and l_quantity > 25")
    return counted(kept, ["o_orderstatus", "o_orderpriority", "l_linestatus"])


# --- buckets -------------------------------------------------------------------------------

_FLAG_STATUS = {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus"}


def _lineitem_segments(t: Tables) -> DataFrame:
    """Segments over price and over the heavily tied discount."""
    return buckets.train_buckets(
        t["lineitem"],
        _FLAG_STATUS,
        {"price": "l_extendedprice / 1e6D", "discount": "l_discount"},
        method="exact",
    )


@query
def percentile_cuts_exact(t: Tables) -> DataFrame:
    cuts = percentiles.exact_cuts(
        t["lineitem"],
        ["l_returnflag", "l_linestatus"],
        {"price": "l_extendedprice", "discount": "l_discount"},
    )
    return cuts.selectExpr(
        "l_returnflag", "l_linestatus", "posexplode(arrays_zip(price, discount)) as (position, cut)"
    ).select("l_returnflag", "l_linestatus", "position", "cut.price", "cut.discount")


@query
def percentile_cuts_sketch(t: Tables) -> DataFrame:
    """True rank of each sketched cut: within half a percent of the one asked for.

    A cut is right when the share of values below it is at most, and the share up to it at
    least, the probability, give or take the tolerance.
    """
    keys = ["l_returnflag", "l_linestatus"]
    rows = t["lineitem"].select(*keys, F.col("l_extendedprice").alias("x"))
    cuts = via_shared_table(percentiles.sketch_cuts(rows, keys, {"cuts": "x"}), "sketch-cuts")
    tolerance = 0.005
    counts, checks = {}, []
    for i, p in enumerate(percentiles.PROBABILITIES):
        counts[f"below_{i}"] = f"count_if(x < cuts[{i}])"
        counts[f"upto_{i}"] = f"count_if(x <= cuts[{i}])"
        checks.append(
            f"named_struct('probability', {p}D, 'within_tolerance',"
            f" below_{i} <= {p + tolerance} * n and upto_{i} >= {p - tolerance} * n)"
        )
    ranked = counted(rows.join(cuts, keys), keys, **counts)
    return ranked.selectExpr(*keys, "n as n_rows", f"inline(array({', '.join(checks)}))")


@query
def bucket_intervals(t: Tables) -> DataFrame:
    return (
        _lineitem_segments(t)
        .select("l_returnflag", "l_linestatus", F.inline("discount"))
        .withColumnsRenamed({"low": "discount_low", "high": "discount_high", "name": "bucket"})
    )


@query
def bucket_grid_v1(t: Tables) -> DataFrame:
    """The stored three-axis table."""
    return prediction_bucket_v1(t["impressions"], START, END, method="exact")


@query
def bucket_grid_v2(t: Tables) -> DataFrame:
    """The stored two-axis table."""
    return prediction_bucket_v2(t["impressions"], START, END, method="exact")


@query
def bucket_assign(t: Tables) -> DataFrame:
    """Line items per grid cell; values enter in other units than the cuts were trained on."""
    segments = via_shared_table(_lineitem_segments(t), "segments")
    cells = buckets.assign_bucket(
        t["lineitem"],
        segments,
        _FLAG_STATUS,
        {"price": ("l_extendedprice", 1e6), "discount": ("l_discount", 1.0)},
    )
    return cells.groupBy(
        "l_returnflag", "l_linestatus", "price_percentile", "discount_percentile", "price_percentile_low", "discount_percentile_high"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query
def bucket_table_round_trip(t: Tables) -> DataFrame:
    """Grid written once, read back, folded to segments and expanded again."""
    grid = via_shared_table(prediction_bucket_v2(t["impressions"], START, END, method="exact"), "grid")
    axes = ["convx", "private_cpm"]
    segments = buckets.segments_from_grid(grid, ["platform", "model_type"], axes)
    return buckets.bucket_grid(segments, axes)


@query
def bucket_grid_v1_window(t: Tables) -> DataFrame:
    """Training over stored hours, both ends left out: rows go by hour, by own day and without a model."""
    return prediction_bucket_v1(typed(t)["impressions"], *TRAINING, method="exact")


@query
def bucket_grid_v2_window(t: Tables) -> DataFrame:
    """Training over stored hours, half-open; a third platform goes too."""
    return prediction_bucket_v2(typed(t)["impressions"], *TRAINING, method="exact")


def _rank_checks(t: Tables, stored: DataFrame, rows: DataFrame, keys: tuple[str, ...], axes: tuple[str, ...]) -> DataFrame:
    """True rank of every stored cut among a window's rows, per segment, axis and probability."""
    tolerance, counts, checks = 0.005, {}, []
    cuts = stored.selectExpr(*keys, *[f"transform({a}, c -> c.low) as {a}_cuts" for a in axes])
    values = rows.selectExpr(
        *[f"{bucket_tables._KEY[k]} as {k}" for k in keys],
        *[f"nullif(cast({bucket_tables._AXIS[a]} as double), double('NaN')) as {a}" for a in axes],
    )
    for a in axes:
        counts[f"n_{a}"] = f"count({a})"
        for i, p in enumerate(percentiles.PROBABILITIES, 1):
            counts[f"{a}_below_{i}"] = f"count_if({a} < {a}_cuts[{i}])"
            counts[f"{a}_upto_{i}"] = f"count_if({a} <= {a}_cuts[{i}])"
            inside = f"{a}_below_{i} <= {p + tolerance} * n_{a} and {a}_upto_{i} >= {p - tolerance} * n_{a}"
            checks.append(f"named_struct('axis', '{a}', 'probability', {p}D, 'n_values', n_{a}, 'within_tolerance', {inside})")
    ranked = counted(values.join(cuts, list(keys)), list(keys), **counts)
    return ranked.selectExpr(*keys, "n as n_rows", f"inline(array({', '.join(checks)}))")


@query
def bucket_sketches_v1_days(t: Tables) -> DataFrame:
    """Two weeks of stored daily sketches, the last day by a run of its own and one day run twice, merged over
    a window with open ends: every cut's true rank among the impressions the window stands for."""
    folder, impressions = new_folder(t.spark, "sketches"), listed(t)["impressions"]
    path, (start, end) = f"{folder}/bucket_sketches_v1", (x[:10] for x in SKETCHED)
    last, twice = fx.day_plus(end, -1), fx.day_plus(start, 3)
    write_hours(daily_sketches_v1(impressions, start, last), path, start, last, at="day")
    for day in (last, twice):
        write_hours(daily_sketches_v1(impressions, day), path, day, fx.day_plus(day, 1), at="day")
    stored = PartitionedTable(t.spark, folder, "bucket_sketches_v1")
    segments = via_shared_table(stored_segments_v1(stored, *SKETCHED), "segments")
    return _rank_checks(t, segments, bucket_tables._training_rows(impressions, *SKETCHED, "neither"), KEYS_V1, AXES_V1)


@query
def bucket_sketches_v2_days(t: Tables) -> DataFrame:
    """The same for the half-open window of the two-axis table."""
    folder, impressions = new_folder(t.spark, "sketches"), listed(t)["impressions"]
    path, (start, end) = f"{folder}/bucket_sketches_v2", (x[:10] for x in SKETCHED)
    write_hours(daily_sketches_v2(impressions, start, end), path, start, end, at="day")
    segments = via_shared_table(stored_segments_v2(PartitionedTable(t.spark, folder, "bucket_sketches_v2"), *SKETCHED), "segments")
    rows = bucket_tables._training_rows(impressions, *SKETCHED, "left").where(bucket_tables._ON_V2)
    return _rank_checks(t, segments, rows, KEYS_V2, AXES_V2)


@query
def bid_validation_hours(t: Tables) -> DataFrame:
    """The bid check as it is used: two stored hours and a few ad groups."""
    return bid_validation(typed(t)["impressions"], t["ad_groups"], *CHECKED_HOURS, ad_group_ids=CHECKED_IDS)


@query
def bid_validation_limit(t: Tables) -> DataFrame:
    """The row limit of the bid check: as many rows as asked for, every one a row of the whole check."""
    whole = via_shared_table(bid_validation(t["impressions"], t["ad_groups"], START, END), "bids")
    asked = [10, 1000, 2_000_000_000]
    rows = whole.withColumn("asked", F.lit(0).cast("bigint"))
    for n in asked:
        some = bid_validation(t["impressions"], t["ad_groups"], START, END, limit=n)
        rows = rows.unionByName(some.withColumn("asked", F.lit(n).cast("bigint")))
    # Equal rows of the whole check and of each limited one are counted side by side.
    each = counted(rows, whole.columns, most="count_if(asked = 0)", **{f"times_{n}": f"count_if(asked = {n})" for n in asked})
    told = ", ".join(
        f"named_struct('n_rows', coalesce(sum(times_{n}), 0L), 'n_in_whole', coalesce(sum(least(times_{n}, most)), 0L), 'asked', {n}L)" for n in asked
    )
    return each.agg(F.expr(f"array({told})").alias("told")).selectExpr("inline(told)")


def listed(t: Tables) -> ListedTables:
    return ListedTables(t.spark, t.folder)


def typed(t: Tables) -> TypedTables:
    return TypedTables(t.spark, t.folder)


def schema_text(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def new_table(folder: str) -> str:
    return folder.rsplit("/", 1)[1].replace("-", "_")


@query
def write_once_keeps_first(t: Tables) -> DataFrame:
    """A second create-once leaves the first result in place."""
    spark = t.spark
    folder = new_folder(spark, "once")
    table = new_table(folder)
    first = t["lineitem"].groupBy("l_returnflag").agg(F.count("*").alias("n"))
    write_once(first, table, folder)
    write_once(first.withColumn("n", F.lit(0).cast("bigint")), table, folder)
    return spark.table(table)


@query
def write_once_keeps_folder(t: Tables) -> DataFrame:
    """A finished folder that the catalog doesn't know is kept, and gets its entry."""
    folder = new_folder(t.spark, "kept")
    counts = t["lineitem"].groupBy("l_returnflag").agg(F.count("*").alias("n"))
    counts.write.parquet(folder)
    write_once(counts.withColumn("n", F.lit(0).cast("bigint")), new_table(folder), folder)
    return t.spark.table(new_table(folder))


@query
def write_once_after_half_run(t: Tables) -> DataFrame:
    """A folder that an unfinished run has left is written again."""
    folder = new_folder(t.spark, "half")
    counts = t["lineitem"].groupBy("l_returnflag").agg(F.count("*").alias("n"))
    unfinished = counts.withColumn("n", F.lit(0).cast("bigint")).write
    unfinished.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)
    write_once(counts, new_table(folder), folder)
    return t.spark.table(new_table(folder))


@query
def write_hour_empty_rerun(t: Tables) -> DataFrame:
    """A second run of an hour that gives no rows empties it; the other hour stays."""
    folder = new_folder(t.spark, "empty")
    counts = t["matched_app_events"].groupBy("custom_event_id").agg(F.count("*").alias("n"))
    write_hour(counts, folder, "2024-01-01T00")
    write_hour(counts, folder, "2024-01-01T01")
    write_hour(counts.where("n < 0"), folder, "2024-01-01T01")
    return t.spark.read.schema("custom_event_id bigint, n bigint, dt string").parquet(folder)


@query
def write_hour_replaces_hour(t: Tables) -> DataFrame:
    """Two days written, one of them written again: it is replaced, the other is kept."""
    spark = t.spark
    folder = new_folder(spark, "hours")
    counts = t["matched_app_events"].groupBy("custom_event_id").agg(F.count("*").alias("n"))
    write_hour(counts, folder, "2024-01-01T00")
    write_hour(counts, folder, "2024-01-01T01")
    write_hour(counts.withColumn("n", F.col("n") * 10), folder, "2024-01-01T01")
    return spark.read.schema("custom_event_id bigint, n bigint, dt string").parquet(folder)


@query
def write_once_without_marker(t: Tables) -> DataFrame:
    """A table finished without any success file is kept, data and all: the catalog knows it by its place."""
    table = new_table(new_folder(t.spark, "unmarked"))
    counts = t["lineitem"].groupBy("l_returnflag").agg(F.count("*").alias("n"))
    counts.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").saveAsTable(table)
    write_once(counts.withColumn("n", F.lit(0).cast("bigint")), table)
    return t.spark.table(table)


@query
def write_hour_failed_swap(t: Tables) -> DataFrame:
    """An hour's replacement that died between its two renames is found and ended; the other hour stays."""
    spark, folder = t.spark, new_folder(t.spark, "swapped")
    counts = t["matched_app_events"].groupBy("custom_event_id").agg(F.count("*").alias("n"))
    write_hour(counts, folder, "2024-01-01T00")
    write_hour(counts, folder, "2024-01-01T01")
    swap, files = f"{folder}/_swap-died", Files(spark)
    counts.withColumn("n", F.col("n") * 10).write.parquet(f"{swap}/dt=2024-01-01T01")
    files.write(f"{swap}/{PLAN}", "2024-01-01T01 1")
    files.move(f"{folder}/dt=2024-01-01T01", f"{swap}/_old/dt=2024-01-01T01")
    recover(spark, folder)
    return spark.read.schema("custom_event_id bigint, n bigint, dt string").parquet(folder)


@query
def backfill_hours(t: Tables) -> DataFrame:
    """Three hours of the second report as one job, over an earlier run of them; one hour has no rows any more."""
    start, empty, until = BACKFILL
    folder = new_folder(t.spark, "backfill")
    report = via_shared_table(platform_health_v2(listed(t), start, until, NOW), "report")
    write_hours(report.withColumn("installs", F.col("installs") + 1), folder, start, until)
    write_hours(report.where(f"substr(at, 1, 13) <> '{empty}'"), folder, start, until)
    return rounded_metrics(t.spark.read.schema(f"{schema_text(report)}, dt string").parquet(folder))


# --- funnel --------------------------------------------------------------------------------


@query
def attribution_coalesce(t: Tables) -> DataFrame:
    """Each column by its own precedence over the three chains of an app event."""
    bid = "impression__bid__"
    exchange = f"{bid}bid_request__exchange"
    latest, origin = fx.LATEST_FIRST, fx.ORIGIN_FIRST
    return counted(
        t["matched_app_events"],
        {
            "platform_v1": fx.first_chain(f"{bid}app_platform", origin),
            "platform_v2": fx.first_chain(f"{bid}app_platform", latest),
            "exchange_group": fx.exchange_group(
                fx.first_chain(exchange, origin), emit=fx.first_chain(exchange, latest)
            ),
            "country_group": fx.country_group(fx.first_country(origin)),
            "campaign_id": fx.first_chain(f"{bid}campaign_id", latest),
            "ad_format": fx.ad_format(fx.first_chain(f"{bid}creative__ad_format", origin)),
            "model_type": fx.model_type(fx.first_chain(f"{bid}price_data__model_type", latest)),
            "click_source": fx.first_chain("click_source", latest),
        },
    )


@query
def target_events(t: Tables) -> DataFrame:
    """Events matching their campaign's target, and first occurrences among them."""
    campaign = fx.first_chain("impression__bid__campaign_id", fx.LATEST_FIRST)
    joined = t["matched_app_events"].join(
        dimensions.campaign_targets(t["campaigns"]), F.expr(f"{campaign} = target_campaign_id"), "left"
    )
    terms = metrics.target_event_terms("cpa_target_event_id", "custom_event_id", "first_occurrence")
    return counted(
        joined,
        {"campaign_id": campaign, "target_customer_id": "target_customer_id"},
        **{name: f"sum({sql})" for name, sql in terms.items()},
    )


def _segments(t: Tables) -> DataFrame:
    return via_shared_table(train_segments_v1(t["impressions"], START, END, method="exact"), "segments")


@query
def funnel_v1(t: Tables) -> DataFrame:
    return rounded_metrics(funnel.funnel(t, START, END, "v1", _segments(t)))


@query
def funnel_v2(t: Tables) -> DataFrame:
    return rounded_metrics(funnel.funnel(t, START, END, "v2"))


@query
def platform_health_v1_report(t: Tables) -> DataFrame:
    return rounded_metrics(platform_health_v1(t, _segments(t), START, END, NOW))


@query
def platform_health_v2_report(t: Tables) -> DataFrame:
    return rounded_metrics(platform_health_v2(t, START, END, NOW))


@query
def platform_health_v1_hour(t: Tables) -> DataFrame:
    """The hourly job as it runs: stored hours, the default of one hour."""
    return rounded_metrics(platform_health_v1(listed(t), _segments(t), IMPRESSION_HOUR, as_of=NOW))


@query
def platform_health_v2_hour(t: Tables) -> DataFrame:
    return rounded_metrics(platform_health_v2(listed(t), EVENT_HOUR, as_of=NOW))


@query
def platform_health_v1_exact_hour(t: Tables) -> DataFrame:
    """The hourly report with exact sums, to the last bit."""
    return platform_health_v1(listed(t), _segments(t), IMPRESSION_HOUR, as_of=NOW, exact=True)


@query
def platform_health_v2_exact_week(t: Tables) -> DataFrame:
    return platform_health_v2(listed(t), *WEEK, NOW, exact=True)


@query
def platform_health_v1_week(t: Tables) -> DataFrame:
    return rounded_metrics(platform_health_v1(typed(t), _segments(t), *WEEK, NOW))


@query
def platform_health_v2_week(t: Tables) -> DataFrame:
    return rounded_metrics(platform_health_v2(typed(t), *WEEK, NOW))


@query
def platform_health_v1_sketched(t: Tables) -> DataFrame:
    """The report on segments trained from stored daily sketches, buckets added up: whatever the cuts are, every
    event with a segment and a value is in one bucket of each axis. The cuts themselves are checked by rank."""
    folder, (start, end) = new_folder(t.spark, "sketches"), (x[:10] for x in SKETCHED)
    path, impressions = f"{folder}/bucket_sketches_v1", listed(t)["impressions"]
    write_hours(daily_sketches_v1(impressions, start, end), path, start, end, at="day")
    segments = via_shared_table(stored_segments_v1(PartitionedTable(t.spark, folder, "bucket_sketches_v1"), *SKETCHED), "segments")
    report = platform_health_v1(listed(t), segments, f"{start}T00", f"{end}T00", NOW)
    longs = [m for m, kind in dict(report.dtypes).items() if m in metrics.METRICS and kind == "bigint"]
    keys = [c for c in report.columns if c not in metrics.METRICS and c not in funnel.BUCKET_KEYS]
    return report.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in longs])


@query
def platform_health_v1_stored(t: Tables) -> DataFrame:
    """The report from a stored grid: written once, read as declared, folded to segments."""
    folder = new_folder(t.spark, "grids")
    write_once(prediction_bucket_v1(t["impressions"], START, END, method="exact"), new_table(folder), f"{folder}/prediction_bucket_v1")
    grid = read_table(t.spark, folder, "prediction_bucket_v1")
    segments = via_shared_table(buckets.segments_from_grid(grid, KEYS_V1, AXES_V1), "segments")
    return rounded_metrics(platform_health_v1(t, segments, START, END, NOW))


@query
def revenue_calibration_series(t: Tables) -> DataFrame:
    series = revenue_calibration(
        t["ad_group_results"],
        t["ad_group_history"],
        f"interval '{CALIBRATION_DAYS}' day",
        f"timestamp_ntz'{CALIBRATION_AS_OF}'",
    )
    return rounded(series, 8)
