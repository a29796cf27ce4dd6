"""Mixing sources to target weights by Pareto order sampling.

Every document gets an expected number of copies. Its whole part is taken for certain; the rest is
the inclusion probability p of one further copy. Documents of a source are ranked by random odds
over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in that order until the words still
missing from the source's target are there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table

#: Slots of the rank axis; the documents of one slot, a 65,536th of a source, are put in exact order.
SLOTS = 1 << 16
#: What longer documents are preferred by: expected copies grow by this much for each doubling in size.
LENGTH_PREFERENCE = 0.05

#: Columns `pareto_mix` adds.
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")

WORDS = r"coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0)"


def cycle_weights(sources: DataFrame, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """source, weight: the weights in turn over the sources by code point, null last."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(cycle)
    return sources.select("source").distinct().select(
        "source", F.element_at(F.array(*map(F.lit, cycle)), turn.cast("int") + 1).alias("weight")
    )


def source_targets(sizes: DataFrame, weights: DataFrame, most_copies: int = 3) -> DataFrame:
    """source, source_size, target: a share of all sizes by weight, at most `most_copies` times the source.

    What sources at their limit can't take is shared anew by weight among the others until none is
    above. With sources ordered by limit over weight, the ones at their limit come first: source i is
    among them while its weight's share of what is left after those before it is above its limit.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    joined = totals.join(weights, totals["source"].eqNullSafe(weights["source"]), "left").select(
        totals["source"], "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")
    )
    everything = Window.partitionBy()
    tight = Window.orderBy(F.expr("source_size / weight").asc_nulls_last(), F.col("source").isNull(), "source")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("source_size") * F.lit(most_copies)
    ranked = joined.select(
        "*",
        limit.alias("limit"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).cast("double").alias("given"),
        F.sum("weight").over(tight.rowsBetween(0, Window.unboundedFollowing)).alias("open_weight"),
    ).withColumn("share", F.expr("if(weight > 0, (total - given) * (weight / open_weight), 0D)"))
    # From the first source within its limit on, every share is by the weights left at that point.
    free = ranked.withColumn("is_free", F.col("share") <= F.col("limit"))
    first = Window.partitionBy("is_free").orderBy(F.col("given"), F.expr("source_size / weight").asc_nulls_last())
    rate = F.first(F.when(F.col("open_weight") > 0, (F.col("total") - F.col("given")) / F.col("open_weight"))).over(first)
    return free.withColumn("rate", rate).select(
        "source",
        "source_size",
        F.expr("if(is_free, coalesce(rate * weight, 0D), cast(limit as double))").alias("target"),
    )


def expected_copies(sizes: DataFrame, targets: DataFrame, most_copies: int, preference: float) -> DataFrame:
    """source, source_size, target, copies: expected copies of a document by its size class.

    copies = min(most_copies, k * (1 + preference * class)), class being the binary logarithm of the
    size. k is the one with which the expected words meet the target; at most 64 classes a source.
    """
    classes = sizes.groupBy("source", "class").agg(F.sum("size").cast("double").alias("words"))
    joined = classes.join(targets, classes["source"].eqNullSafe(targets["source"])).select(
        targets["*"], "class", "words", (F.lit(1.0) + F.lit(preference) * F.col("class")).alias("want")
    )
    # The classes at the limit are those with the largest want: running sums from the top.
    down = Window.partitionBy("source").orderBy(F.col("class").desc())
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(F.col("words") * F.col("want")).over(down.rowsBetween(0, Window.unboundedFollowing))
    k = F.when(rest > 0, (F.col("target") - most_copies * above) / rest)
    steps = joined.withColumn("k", k).withColumn("within", F.expr(f"k * want <= {most_copies}"))
    best = F.max(F.when(F.col("within"), F.struct("class", "k"))).over(Window.partitionBy("source"))
    share = F.expr(
        f"case when class = 0 or k is null then 0D when within then greatest(best.k, 0D) * want else {most_copies}D end"
    )
    return (
        steps.withColumn("best", best)
        .withColumn("share", share)
        .groupBy("source", "source_size", "target")
        .agg(F.map_from_entries(F.collect_list(F.struct("class", "share"))).alias("copies"))
    )


def _measured(documents: DataFrame, seed: int) -> DataFrame:
    return documents.withColumns(
        {"size": F.expr(WORDS).cast("long"), "draw": F.xxhash64("doc_id", "text", F.lit(seed))}
    )


def _ranked(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the plan's columns, `whole` copies, and the Pareto rank of one more: q / (1 + q) in (0, 1), or 1."""
    plan = plan.withColumnRenamed("source", "plan_source")
    return (
        measured.join(plan, measured["source"].eqNullSafe(plan["plan_source"]))
        .drop("plan_source")
        .withColumn("share", F.expr("coalesce(copies[cast(log2(size + 1) as int)], 0D)"))
        .withColumn("whole", F.expr("cast(floor(share) as int)"))
        .withColumn("p", F.expr("share - whole"))
        .withColumn("u", F.expr("(pmod(draw, 9007199254740881L) + 0.5D) / 9007199254740881D"))
        .withColumn("rank", F.expr("if(p > 0 and size > 0, u * (1 - p) / (u * (1 - p) + (1 - u) * p), 1D)"))
        .drop("share", "p", "u", "copies")
    )


def mix_plan(documents: DataFrame, weights: DataFrame | None, most_copies: int, seed: int, preference: float) -> DataFrame:
    """One row per source: its size, target, expected copies by class, and the last rank and draw taken."""
    sizes = _measured(documents.select("doc_id", "source", "text"), seed).select("source", "size", "draw")
    sizes = via_shared_table(sizes.withColumn("class", F.expr("cast(log2(size + 1) as int)")), "mix-sizes")
    targets = source_targets(sizes, weights if weights is not None else cycle_weights(sizes), most_copies)
    plan = via_shared_table(expected_copies(sizes, targets, most_copies, preference), "mix-plan")

    slot = F.expr(f"if(rank < 1, cast(least(rank * {SLOTS}, {SLOTS - 1}) as int), {SLOTS})")
    ranked = _ranked(sizes, plan).withColumn("slot", slot)
    slots = ranked.groupBy("source", "target", "slot").agg(
        F.sum(F.when(F.col("slot") < SLOTS, F.col("size"))).alias("words"),
        F.sum(F.col("whole") * F.col("size")).alias("certain"),
    )
    of_source = Window.partitionBy("source")
    upto = F.coalesce(F.sum("words").over(of_source.orderBy("slot")), F.lit(0))
    cuts = (
        slots.withColumns({"missing": F.col("target") - F.sum("certain").over(of_source), "upto": upto})
        .where(f"upto > missing and slot < {SLOTS}")
        .groupBy(F.col("source").alias("cut_source"))
        .agg(F.min(F.struct("slot", F.expr("upto - words").alias("before"), "missing")).alias("cut"))
        .select("cut_source", "cut.before", "cut.missing", F.col("cut.slot").alias("cut_slot"))
    )
    cuts = via_shared_table(cuts, "mix-cuts")
    # In the one slot where the target is passed: as many documents as bring the sum nearest to it.
    edge = ranked.join(cuts, ranked["source"].eqNullSafe(cuts["cut_source"]) & (ranked["slot"] == cuts["cut_slot"]))
    after = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("rank", "draw"))
    last = (
        edge.withColumn("after", after)
        .groupBy(F.col("cut_source").alias("last_source"), "cut_slot")
        .agg(F.max(F.when(F.expr("after - size / 2D <= missing"), F.struct("rank", "draw"))).alias("last"))
    )
    # Without a last one in its slot, all of the slots before it are taken; without a slot, all.
    slot_start = F.struct((F.col("cut_slot") / F.lit(float(SLOTS))).alias("rank"), F.lit(-(1 << 63)).alias("draw"))
    everything = F.struct(F.lit(0.9999999999999999).alias("rank"), F.lit((1 << 63) - 1).alias("draw"))
    return (
        plan.join(last, plan["source"].eqNullSafe(last["last_source"]), "left")
        .withColumn("last", F.when(F.col("cut_slot").isNull(), everything).otherwise(F.coalesce("last", slot_start)))
        .drop("last_source", "cut_slot")
    )


def pareto_mix(
    documents: DataFrame,
    weights: DataFrame | None = None,
    most_copies: int = 3,
    seed: int = 17,
    preference: float = LENGTH_PREFERENCE,
) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target and mix_copies added, one row per row.

    `mix_size` is the number of words of the text, 0 for null; `mix_copies` is how often the mix holds
    the row, 0 to `most_copies`. `weights` (source, weight) defaults to 1, 2, 3 in turn; sources
    without a weight are left out of the mix. Draws are hashes of doc_id and text, so reruns agree
    and rows alike in both are taken alike. Documents without words have no copies. An empty table
    gives no rows. The first of two scans only counts words; the second
    looks each row up in a table of one row per source, so no text is shuffled unless there are so
    many sources that Spark won't broadcast that table. Columns of `documents` named like an added one
    give way to it; other names are free.
    """
    documents = documents.select(*[c for c in documents.columns if c.lower() not in ADDED])
    plan = via_shared_table(mix_plan(documents, weights, most_copies, seed, preference), "mix-plan")
    names = {c: f"mix_doc_{c}" for c in documents.columns if c not in ("doc_id", "source", "text")}
    ranked = _ranked(_measured(documents.withColumnsRenamed(names), seed), plan)
    more = F.expr("rank < 1 and struct(rank, draw) <= last").cast("int")
    return ranked.select(
        *[F.col(names.get(c, c)).alias(c) for c in documents.columns],
        F.col("size").alias("mix_size"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        (F.col("whole") + more).alias("mix_copies"),
    )


def mixed_documents(documents: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """The mix itself: the rows of `documents`, each as often as it is taken."""
    own = {c: f"mix_kept_{i}" for i, c in enumerate(documents.columns) if c not in ("doc_id", "source", "text")}
    taken = pareto_mix(documents.withColumnsRenamed(own), weights, **options).where("mix_copies > 0")
    copied = taken.select("*", F.explode(F.expr("sequence(1, mix_copies)")).alias("mix_copy"))
    return copied.select(*[F.col(own.get(c, c)).alias(c) for c in documents.columns])
