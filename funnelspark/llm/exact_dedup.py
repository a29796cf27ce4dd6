"""Exact deduplication by content-defined chunk recipes, with DataFrame operations only.

A text is cut at places that depend on its content, and becomes the ordered list of its chunks'
hashes, its recipe. Recipes, about a fiftieth of the text, are what is grouped. Where recipes of
several rows agree, digests of their distinct chunks verify that equal hashes stand for equal
chunks; a hash that doesn't gets one ordinal per chunk. The verified identifier of a chunk is its
hash and ordinal, and documents are equal when their ordered lists of identifiers are. No text is
moved at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table

#: A chunk ends after the first place past 128 characters where five characters come from these sets,
#: at the latest after 2,048. The pattern meets prose every few hundred characters, so rarely that
#: chunks fall into step again soon after an insertion.
CHUNK = r"(?s).{128}.{0,1915}?[aeiouаеиоу一-乿][mnpstмнпст丐-俿][aeiouаеиоу一-乿][^aeioumnpst]{2}|.{1,2048}"


def normalised(text: str = "text") -> Column:
    """The text without space and \\t to \\r; null counts as empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), " \t\n\x0b\f\r", "")


def chunks_of(text: Column) -> Column:
    """The chunks of a text in order; joined, they give the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _hash(chunk: Column, bits: int) -> Column:
    return F.shiftright(F.xxhash64(chunk), 64 - bits)


def recipes(documents: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, n_points, text_sha256 and recipe, the chunk hashes in order, of every row."""
    plain = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_points"), normalised().alias("plain"))
    return plain.select(
        "doc_id",
        "n_points",
        F.sha2("plain", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("plain")), lambda c: _hash(c, bits)).alias("recipe"),
    )


def ambiguous_hashes(documents: DataFrame, shared: DataFrame, bits: int = 64) -> DataFrame:
    """hash, digest, ordinal of the chunks whose hash stands for other chunks too; as good as always none.

    `shared` holds the keys of recipes that several rows have. The chunks of their documents are told
    apart by SHA-256, so 40 bytes a chunk are moved and no text.
    """
    chunked = documents.select(chunks_of(normalised()).alias("chunks")).withColumn(
        "recipe", F.transform("chunks", lambda c: _hash(c, bits))
    )
    digests = (
        chunked.select(F.xxhash64("recipe").alias("recipe_key"), F.explode("chunks").alias("chunk"))
        .select("recipe_key", _hash(F.col("chunk"), bits).alias("hash"), F.unhex(F.sha2("chunk", 256)).alias("digest"))
        .join(shared, "recipe_key", "left_semi")
        .select("hash", "digest")
        .distinct()
    )
    digests = via_shared_table(digests, "chunk-digests")
    ambiguous = digests.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    ordinal = F.row_number().over(Window.partitionBy("hash").orderBy("digest"))
    return via_shared_table(digests.join(ambiguous, "hash", "left_semi").withColumn("ordinal", ordinal), "ambiguous-hashes")


def exact_groups(documents: DataFrame, bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are after deleting space and \\t to \\r; null counts as empty. Of
    equal rows, the one with the most code points in its original text, then the smallest doc_id, has
    `kept` true. Rows alike in doc_id and text count each in group_size, and one of them is kept. A
    null doc_id is the largest. Other columns are not looked at; an empty table gives no rows. `bits`
    shortens the hashes, for tests of what happens when they collide.
    """
    rows = via_shared_table(recipes(documents, bits), "recipes")
    rows = rows.groupBy("doc_id", "n_points", "text_sha256", "recipe").agg(F.count("*").alias("n_rows"))
    rows = via_shared_table(rows.withColumn("recipe_key", F.xxhash64("recipe")), "recipe-rows")
    shared = rows.groupBy("recipe_key").agg(F.count("*").alias("n")).where("n > 1").select("recipe_key")
    ambiguous = ambiguous_hashes(documents, via_shared_table(shared, "shared-recipes"), bits)

    # The ordinals of a document's ambiguous chunks, by place; joined only where there are any.
    placed = documents.select(
        "doc_id", F.sha2(normalised(), 256).alias("text_sha256"), F.posexplode(chunks_of(normalised())).alias("place", "chunk")
    ).select("doc_id", "text_sha256", "place", _hash(F.col("chunk"), bits).alias("hash"), F.unhex(F.sha2("chunk", 256)).alias("digest"))
    if ambiguous.isEmpty():
        verified = rows.withColumn("ordinals", F.array().cast("array<struct<place:int,ordinal:int>>"))
    else:
        ordinals = (
            placed.join(ambiguous, ["hash", "digest"])
            .groupBy(F.col("doc_id").alias("of_id"), F.col("text_sha256").alias("of_text"))
            .agg(F.array_sort(F.collect_set(F.struct("place", "ordinal"))).alias("ordinals"))
        )
        verified = rows.join(
            ordinals, rows["doc_id"].eqNullSafe(ordinals["of_id"]) & (rows["text_sha256"] == ordinals["of_text"]), "left"
        ).withColumn("ordinals", F.coalesce("ordinals", F.array().cast("array<struct<place:int,ordinal:int>>")))

    first = F.expr("coalesce(-doc_id - 1, -9223372036854775808)")
    best = F.max(F.struct("n_points", first.alias("first")))
    groups = (
        verified.groupBy("recipe_key", "recipe", "ordinals")
        .agg(best.alias("best"), F.sum("n_rows").alias("group_size"))
        .withColumn("keep_id", F.expr("nullif(-(best.first + 1), 9223372036854775807)"))
    )
    joined = verified.join(groups, ["recipe_key", "recipe", "ordinals"])
    is_best = joined["doc_id"].eqNullSafe(joined["keep_id"]) & (F.col("n_points") == F.col("best.n_points"))
    return joined.withColumn("is_best", is_best).select(
        "doc_id", "keep_id", "group_size", F.expr("posexplode(array_repeat(is_best, cast(n_rows as int))) as (copy, best)"), "text_sha256"
    ).select("doc_id", "keep_id", "group_size", F.expr("best and copy = 0").alias("kept"), "text_sha256")


def deduplicate(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that are kept, all columns; of rows alike in doc_id and text any one."""
    kept = exact_groups(documents).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text"))
    same = documents["doc_id"].eqNullSafe(kept["_kept_id"]) & (F.sha2(normalised(), 256) == kept["_kept_text"])
    joined = documents.join(kept, same)
    return joined.dropDuplicates(["doc_id", "_kept_text"]).select(*[documents[c] for c in documents.columns])
