"""Dimension lookups: one row per key, CRM snapshots, left-join enrichment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.readers import PartitionedTable, latest_partition
from funnelspark.sources.sinks import intermediates, shuffles_released, via_shared_table

#: Columns that `attach_all` leaves where it has dealt rows out by them: a sum that groups by these too needs no exchange.
DEALT = ("_ids", "_salt")


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark keeps one row per key and task before the shuffle (window group limit), so a hot key
    does not gather its rows in one place. Give enough order columns to leave no ties.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def primary_goal(goals: DataFrame, tiebreak: Sequence[str] = ("type", "target_value")) -> DataFrame:
    """Lowest-priority-number goal per campaign, pacing goals and goals without a priority aside."""
    candidates = goals.where("priority is not null and type <> 'pacing-model'")
    order = [F.col(c).asc_nulls_last() for c in ("priority", *tiebreak)]
    return top1_per_key(candidates, ["campaign_id"], order).select(
        "campaign_id", "priority", "type", "target_value"
    )


def campaign_targets(campaigns: DataFrame) -> DataFrame:
    """Target event, app and customer of each campaign, named for joining to facts."""
    return campaigns.selectExpr(
        "id as target_campaign_id",
        "cpa_target_event_id",
        "app_id as target_app_id",
        "customer_id as target_customer_id",
    )


def newest_snapshot(snapshots: DataFrame | PartitionedTable, lookback_days: int, as_of: str) -> DataFrame:
    """Rows of the newest daily snapshot within the look-back."""
    if isinstance(snapshots, PartitionedTable):
        return snapshots.newest(lookback_days, as_of)
    latest = latest_partition(snapshots, lookback_days, as_of)
    return snapshots.where(F.col("dt") == latest.scalar())


def crm_campaign_v1(
    crm_campaigns: DataFrame | PartitionedTable,
    campaigns: DataFrame,
    as_of: str = "current_timestamp()",
    lookback_days: int = 2,
) -> DataFrame:
    """Sales attributes per campaign from the newest CRM snapshot; duplicates are kept."""
    crm = newest_snapshot(crm_campaigns, lookback_days, as_of)
    ids = campaigns.selectExpr("id as campaign_id", "salesforce_campaign_id")
    return crm.join(ids, F.expr("campaign_id_18_digit__c = salesforce_campaign_id")).selectExpr(
        "campaign_id",
        "sales_region__c as sales_region",
        "service_level__c as service_level",
        "sales_sub_region__c as sales_sub_region",
    )


def crm_campaign_v2(
    crm_campaigns: DataFrame | PartitionedTable,
    crm_opportunities: DataFrame | PartitionedTable,
    campaigns: DataFrame,
    as_of: str = "current_timestamp()",
    lookback_days: int = 4,
) -> DataFrame:
    """Sales attributes and scale zone per enabled campaign, through its opportunity.

    Both snapshots are filtered to their newest day, so campaigns without a match on either
    side do not appear: the joins are inner.
    """
    enabled = campaigns.where("state = 'enabled'").selectExpr(
        "customer_id", "id as campaign_id", "salesforce_campaign_id"
    )
    crm = newest_snapshot(crm_campaigns, lookback_days, as_of).drop("dt")
    opportunities = newest_snapshot(crm_opportunities, lookback_days, as_of).drop("dt")
    return (
        enabled.join(crm, F.expr("campaign_id_18_digit__c = salesforce_campaign_id"))
        .join(opportunities, F.expr("opportunity_id_18_digit__c = opportunity__c"))
        .selectExpr(
            "customer_id",
            "campaign_id",
            "sales_region__c as sales_region",
            "sales_sub_region__c as sales_sub_region",
            "scale_zone__c as scale_zone",
            "service_level__c as service_level",
        )
    )


def attach(
    facts: DataFrame, dimension: DataFrame, on: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """Left join a dimension: `on` maps fact columns to its keys, `take` maps its columns to new names.

    A dimension row that repeats a key repeats the fact, as a plain join does. There is no
    broadcast hint: Spark broadcasts when the side's size is known to be under the threshold,
    and otherwise sort-merges. It then splits partitions that turn out skewed, unless something
    above needs the rows of a key together, such as a sum or a second join on the same key.
    """
    side = dimension.selectExpr(
        *[f"{key} as _dim_{key}" for key in on.values()],
        *[f"{column} as {name}" for column, name in take.items()],
    )
    condition = " and ".join(f"{column} = _dim_{key}" for column, key in on.items())
    joined = facts.join(side, F.expr(condition), "left")
    return joined.drop(*[f"_dim_{key}" for key in on.values()])


def fits_broadcast(dimension: DataFrame) -> bool:
    """Whether Spark knows the side to be within its broadcast threshold."""
    spark = dimension.sparkSession
    threshold = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(dimension._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold


def heavy_keys(facts: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """keys, salts: the keys held by more than one row in `parts`, and how many such shares each holds.

    There are fewer than `parts` of them, whatever the data. Null keys are left out.
    """
    counts = facts.dropna(subset=list(keys)).groupBy(*keys).agg((F.count("*") * parts).alias("n"))
    total = facts.agg(F.count("*")).scalar()
    return counts.where(F.col("n") > total).select(*keys, F.ceil(F.col("n") / total).cast("int").alias("salts"))


def attach_spread(
    facts: DataFrame, dimension: DataFrame, on: Mapping[str, str], take: Mapping[str, str], parts: int | None = None, dealt: Sequence[str] = ()
) -> DataFrame:
    """`attach` for a dimension too large to broadcast, with the rows of heavy keys dealt over many tasks.

    Rows of a key that holds more than one row in `parts` get a salt, in proportion to their number, and only
    that key's dimension rows are repeated, once for each salt. Rows with a null key, which match nothing,
    are dealt over all. Other rows are joined as ever. `facts` is read three times and should be stored.
    With `dealt`, columns, the salt is taken from these alone and stays, as `_salt`, and rows are dealt to tasks by
    key and salt however the dimension is joined.
    """
    parts = parts or 32 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = via_shared_table(heavy_keys(facts, list(on), parts), "heavy-keys")  # under `parts` rows
    heavy = F.broadcast(heavy.select(*[F.col(c).alias(f"_heavy_{i}") for i, c in enumerate(on)], F.col("salts").alias("_salts")))
    by_fact = " and ".join(f"`{c}` = _heavy_{i}" for i, c in enumerate(on))
    unknown = " or ".join(f"`{c}` is null" for c in on)
    salted = facts.join(heavy, F.expr(by_fact), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in dealt or facts.columns]), F.expr(f"if({unknown}, {parts}, coalesce(_salts, 1))")).cast("int")
    )
    if dealt:
        salted = salted.repartition(*on, "_salt")
    side = dimension.selectExpr(
        *[f"{key} as _dim_{i}" for i, key in enumerate(on.values())],
        *[f"{column} as {name}" for column, name in take.items()],
    )
    by_key = " and ".join(f"_dim_{i} = _heavy_{i}" for i, _ in enumerate(on))
    side = side.join(heavy, F.expr(by_key), "left").withColumn("_dim_salt", F.explode(F.expr("sequence(0, coalesce(_salts, 1) - 1)")))
    side = side.drop("_salts", *[f"_heavy_{i}" for i, _ in enumerate(on)])
    condition = " and ".join([*[f"`{c}` = _dim_{i}" for i, c in enumerate(on)], "_salt = _dim_salt"])
    return salted.join(side, F.expr(condition), "left").select(*[F.col(f"`{c}`") for c in facts.columns], *take.values(), *["_salt"] * bool(dealt))


def _attached_to_ids(facts: DataFrame, steps: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]]) -> DataFrame:
    """What dimensions know of the ids that occur together in the facts: `_ids`, a struct of them, and what is taken.

    Ids occur together far less often than facts, and these rows hold no measures.
    """
    known = facts.select(*dict.fromkeys(c for _, on, _ in steps for c in on)).distinct()
    ids = known.columns
    with intermediates(facts.sparkSession):
        for step in steps:
            known = attach_spread(via_shared_table(known, "ids"), *step)
        taken = [c for c in known.columns if c not in ids]
        # Equal in a struct, nulls find each other.
        return via_shared_table(known.select(F.struct(*ids).alias("_ids"), *taken), "known", outlive=True)


def attach_all(
    facts: DataFrame,
    steps: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]],
    narrow: Callable[[], tuple[DataFrame, Sequence[str], Callable[[DataFrame], DataFrame]]] | None = None,
) -> DataFrame:
    """(dimension, on, take) after (dimension, on, take), as by `attach`.

    While every dimension fits a broadcast that is one pass over the facts, without a shuffle. One that
    doesn't by Spark's estimate is stored, what is needed of it, to know its true size. If it still
    doesn't, the facts, which are sums here, are stored once. Several large ones are attached to the ids that occur
    together in the facts, and what is known of these to the facts, so that the facts are shuffled once however
    many there are, and before they are widened. `attach_spread` does each step: no task gets a hot key's rows. The small
    ones come after, on rows that are not stored again. By which columns the facts are dealt then, `DEALT`
    names; those of them that are there come after the others. What is shuffled on the way is removed step by step.

    `narrow` gives rows that stand for the facts where these have to be stored and shuffled, the columns they are spread
    by, and a function that adds the columns they lack. Rows that a later sum puts together must agree in the former.
    """
    order = facts.columns + [name for _, _, take in steps for name in take.values()]
    small, large = [], []
    with shuffles_released(facts.sparkSession):
        for dimension, on, take in steps:
            if not fits_broadcast(dimension):
                dimension = via_shared_table(dimension.select(*dict.fromkeys([*on.values(), *take])), "dimension")
            (small if fits_broadcast(dimension) else large).append((dimension, on, take))
        if large:
            rows, by, widened = narrow() if narrow else (facts, facts.columns, lambda df: df)
            rows = via_shared_table(rows, "sums")
            if len(large) == 1:
                facts = widened(attach_spread(rows, *large[0], None, by))
            else:
                known = _attached_to_ids(rows, large)
                ids = known.schema["_ids"].dataType.names
                rows = rows.select(F.struct(*ids).alias("_ids"), *[c for c in rows.columns if c not in ids])
                taken = {c: c for c in known.columns if c != "_ids"}
                spread = attach_spread(rows, known, {"_ids": "_ids"}, taken, None, [c for c in rows.columns if c in (*by, "_ids")])
                facts = widened(spread).select("*", *[F.col(f"_ids.{c}").alias(c) for c in ids])
    for step in small:
        facts = attach(facts, *step)
    return facts.select(*order, *[c for c in DEALT if c in facts.columns])


def campaign_dimension(
    campaigns: DataFrame,
    attached: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]],
    take: Mapping[str, str],
) -> DataFrame:
    """campaign_id and everything known by campaign, so that facts are joined by campaign once.

    `attached` are (dimension, on, take) as for `attach`, joined in order to the campaigns' own columns
    (`take`). Campaigns that only dimensions keyed by `campaign_id` know have a row too, with nulls
    for what they lack. A key that several rows of a dimension hold repeats the campaign, as
    joining the facts would repeat them.
    """
    by_campaign = [d.select("campaign_id") for d, on, _ in attached if "campaign_id" in on]
    ids = campaigns.select(F.col("id").alias("campaign_id"))
    for more in by_campaign:
        ids = ids.unionByName(more)
    known = attach(ids.where("campaign_id is not null").distinct(), campaigns, {"campaign_id": "id"}, take)
    for dimension, on, columns in attached:
        known = attach(known, dimension, on, columns)
    return known


def repeated_keys(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count: the ones a left join would fan out."""
    return dimension.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
