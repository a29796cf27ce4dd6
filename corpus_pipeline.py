"""A training corpus from `documents`, in stages that each write Parquet for the next one.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of `documents`. Null texts count as empty and pass; repeated rows are documents of their own until
the near-duplicate stage; an empty table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelspark.llm.line_dedup import drop_lines
from funnelspark.llm.mixing import mixed_documents
from funnelspark.llm.ngram_join import one_of_each
from funnelspark.llm.packing import pack_documents
from funnelspark.llm.toxicity import reject, train
from funnelspark.llm.workers import lean
from funnelspark.sources.sinks import Files, intermediates, shared_folder

# Text classifiers, set joins and best-fit packing are beyond SQL; the stages are tested one by one
# against brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not, by a model fitted on the folder's labels, go."""
    return reject(docs, train(docs, lean(spark).read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, and documents of which no words are left after that."""
    lean(spark)
    cut = drop_lines(docs)
    return cut.where(r"removed_lines is null or text rlike '[^\\x20\\x09-\\x0D]'").select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays."""
    lean(spark)
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens; one row per piece of a document."""
    import public_tokenizers

    lean(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's `documents`. What a stage has stored on its way goes once it is written, and
    what it has written once the next one is."""
    docs = lean(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder, files = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", Files(spark)
    for i, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{i}"
        with intermediates(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        files.delete(f"{folder}/{i - 1}")
    return docs
