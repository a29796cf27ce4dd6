"""Rows told apart, and columns of one's own beside any the caller has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table


def free_name(df: DataFrame, wanted: str) -> str:
    """The name, lengthened until no column of the table has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(documents: DataFrame) -> tuple[DataFrame, str]:
    """The documents, and the column that tells their rows apart, in the order of doc_id; null where that is.

    That is doc_id itself where no two rows share one. Otherwise it is a number added to a copy of the
    table in the shared folder, sorted by doc_id over all its partitions: rows of one doc_id come one after
    another, in no fixed order, and its number rises with doc_id.
    """
    repeated = documents.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return documents, "doc_id"
    name, spread = free_name(documents, "row_number"), free_name(documents, "row_spread")
    dealt = documents.withColumn(spread, F.monotonically_increasing_id()).repartitionByRange("doc_id", spread)
    placed = dealt.drop(spread).sortWithinPartitions("doc_id")
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    return via_shared_table(placed.withColumn(name, number), "numbered"), name
