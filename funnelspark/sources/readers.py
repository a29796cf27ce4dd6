"""Scans: typed Parquet reads, hour ranges, newest snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from funnelspark.functions.times import hour_range
from funnelspark.sources.schemas import SCHEMAS
from funnelspark.sources.sinks import Files


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read `<root>/<name>` with its declared schema; `dt` stays a string partition column."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


class PartitionedTable:
    """A stored table of `dt` partitions, of which only the folders asked for are opened.

    Reading the whole table by its path makes Spark list the files of every partition there ever was, even if
    a filter then keeps one hour. Here the partition names alone are listed, in one request, when they are
    first needed; a scan then lists and reads only the folders in its range.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name, self.path = spark, name, f"{root.rstrip('/')}/{name}"
        self._days: list[str] | None = None

    def partitions(self) -> list[str]:
        """The values of `dt`, in order."""
        if self._days is None:
            names = Files(self.spark).names(self.path)
            self._days = [n.removeprefix("dt=") for n in names if n.startswith("dt=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
        return self._days

    def listed(self) -> DataFrame:
        """One row per partition, its `dt`: a local relation, without a task or a file behind it."""
        return self.spark.createDataFrame([(p,) for p in self.partitions()], "dt string")

    def read(self, partitions: list[str]) -> DataFrame:
        """The rows of some partitions, typed as declared; no rows for none."""
        schema = SCHEMAS[self.name]
        if not partitions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*[f"{self.path}/dt={p}" for p in partitions])

    def hours(self, start: str, end: str, closed: str = "left") -> DataFrame:
        """Rows of an hour range."""
        kept = self.listed().where(hour_range("dt", start, end, closed)).orderBy("dt").collect()  # names of the range
        return self.read([r.dt for r in kept])

    def newest(self, lookback_days: int, as_of: str = "current_timestamp()") -> DataFrame:
        """Rows of the newest snapshot within the look-back; none when there is none."""
        newest = latest_partition(self.listed(), lookback_days, as_of).first().latest_dt
        return self.read([] if newest is None else [newest])


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame | PartitionedTable:
    """`<root>/<name>` for the jobs: a table with a `dt` by its partitions, another as `read_table` has it."""
    return PartitionedTable(spark, root, name) if "dt" in SCHEMAS[name].names else read_table(spark, root, name)


def scan_hours(facts: DataFrame | PartitionedTable, start: str, end: str, closed: str = "left") -> DataFrame:
    """Rows of an hour range. On a table partitioned by `dt` only those folders are read."""
    if isinstance(facts, PartitionedTable):
        return facts.hours(start, end, closed)
    return facts.where(hour_range("dt", start, end, closed))


def latest_partition(
    snapshots: DataFrame, lookback_days: int, as_of: str = "current_timestamp()", dt: str = "dt"
) -> DataFrame:
    """One row, one column: the newest snapshot within the look-back, null when there is none.

    Reads the partition column alone. Use it as `df.where(F.col("dt") == latest_partition(df, 2).scalar())`:
    the comparison is a run-time partition filter, and a null newest snapshot keeps no rows. Over
    `PartitionedTable.listed()` it looks at no files.
    """
    recent = f"to_timestamp({dt}) >= {as_of} - interval '{int(lookback_days)}' day"
    return snapshots.where(recent).agg(F.max(dt).alias("latest_dt"))


def flatten_records(df: DataFrame) -> DataFrame:
    """Nested structs to flat columns named by their path, parts joined with `__`."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                out += leaves(field.dataType, here)
            else:
                out.append(F.col(".".join(f"`{part}`" for part in here)).alias("__".join(here)))
        return out

    return df.select(*leaves(df.schema, ()))
