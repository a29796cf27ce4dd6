"""URL filtering against dated lists, with DataFrame operations only.

Dated entries of a pattern become validity intervals. A capture asks for all keys it can match (its
host, the host's parent domains, and path prefixes), and an as-of join finds the entries that were
valid when it was fetched. Keys and months are joined by equality, so a host with a third of all
captures meets only the few intervals of one month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table

#: Seconds of the time slots that intervals are cut into for the join.
SLOT = 32 * 86400

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)"


def host_of(url: str) -> Column:
    """The host in lower case, without user, port or a closing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _AUTHORITY, 1)), r"\.+$", "")


def segments_of(url: str) -> Column:
    """The non-empty segments of the path."""
    path = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PATH, 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def validity_intervals(entries: DataFrame) -> DataFrame:
    """pattern, verdict, valid_from, valid_to (seconds, excluded; null: still valid) from dated entries.

    `entries` has pattern (a host, or host/path), action ('block', 'allow' or 'remove') and listed_at.
    An entry is valid until the pattern's next one; 'remove' only ends the one before. Of entries of a
    pattern at the same time, 'block' goes before 'allow' before 'remove'. Patterns are compared in lower
    case of the host, without a leading '*.' or '.' and a closing '/'. Entries with a null, or another
    action, are no entries.
    """
    pattern = F.regexp_replace(F.regexp_replace("pattern", r"^\*?\.", ""), "/+$", "")
    cut = F.instr(pattern, "/")
    lowered = F.when(cut > 0, F.concat(F.lower(F.substring_index(pattern, "/", 1)), F.expr("substring(p, locate('/', p))"))).otherwise(F.lower(pattern))
    clean = (
        entries.where("pattern is not null and listed_at is not null and action in ('block', 'allow', 'remove')")
        .withColumn("p", pattern)
        .select(lowered.alias("pattern"), "action", F.col("listed_at").cast("timestamp").cast("long").alias("valid_from"))
        .where("pattern != ''")
        .groupBy("pattern", "valid_from")
        .agg(F.min_by("action", F.expr("case action when 'block' then 0 when 'allow' then 1 else 2 end")).alias("verdict"))
    )
    following = F.lead("valid_from").over(Window.partitionBy("pattern").orderBy("valid_from"))
    return clean.withColumn("valid_to", following).where("verdict != 'remove'").select("pattern", "verdict", "valid_from", "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture: capture_id, url, fetched_at, verdict, pattern, listed_from.

    The most specific valid entry decides: more path segments, then more host labels. `verdict` is null
    and so are the others where no entry is valid, for a null url or time, and for a url without a host.
    Rows alike in capture_id, url and fetched_at are one capture. An entry is valid from its own second on.
    """
    intervals = via_shared_table(validity_intervals(entries), "list-intervals")
    deepest = intervals.agg(F.max(F.length("pattern") - F.length(F.replace("pattern", F.lit("/"), F.lit(""))))).first()[0] or 0
    seconds = F.col("fetched_at").cast("timestamp").cast("long")
    first, last = captures.agg(F.min(seconds), F.max(seconds)).first()
    slot = F.floor(F.col("second") / SLOT)
    if first is None:
        slotted = intervals.where("false").withColumn("slot", F.lit(0).cast("long"))
    else:
        begin = F.greatest("valid_from", F.lit(first))
        end = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(last)), F.lit(last))
        slotted = intervals.where((begin <= end)).withColumn(
            "slot", F.explode(F.sequence(F.floor(begin / SLOT), F.floor(end / SLOT)))
        )
    slotted = slotted.withColumnRenamed("slot", "list_slot")

    asked = captures.select("capture_id", "url", "fetched_at").withColumns(
        {"second": seconds, "host": host_of("url"), "segments": segments_of("url")}
    )
    labels = "split(host, '[.]')"
    domains = f"transform(sequence(1, size({labels})), i -> struct(array_join(slice({labels}, i, size({labels})), '.') as key, 0 as depth, size({labels}) - i + 1 as labels))"
    prefixes = (
        f"transform(sequence(1, least(size(segments), {deepest})), d -> struct(concat(host, '/', array_join(slice(segments, 1, d), '/')) as key,"
        f" d as depth, size({labels}) as labels))"
    )
    none = "array()"
    keys = f"case when host = '' then {none} when size(segments) = 0 or {deepest} = 0 then {domains} else concat({domains}, {prefixes}) end"
    asked = asked.withColumn("slot", slot).select(
        "capture_id", "url", "fetched_at", "second", "slot", F.explode_outer(F.expr(keys)).alias("k")
    )
    found = asked.join(
        slotted,
        (F.col("k.key") == slotted["pattern"]) & (F.col("slot") == slotted["list_slot"])
        & (F.col("second") >= slotted["valid_from"]) & (slotted["valid_to"].isNull() | (F.col("second") < slotted["valid_to"])),
        "left",
    )
    hit = F.when(F.col("verdict").isNotNull(), F.struct("k.depth", "k.labels", "verdict", "pattern", "valid_from"))
    return found.groupBy("capture_id", "url", "fetched_at").agg(F.max(hit).alias("hit")).select(
        "capture_id", "url", "fetched_at", "hit.verdict", "hit.pattern", F.col("hit.valid_from").cast("timestamp").alias("listed_from")
    )
