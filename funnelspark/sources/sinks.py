"""Writes: create-once tables, hours of a table replaced, intermediate tables in the shared folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelspark.functions.text import quoted
from funnelspark.functions.times import hours_between

#: What `write_once` leaves in a folder it has finished, and a swap of hours in one it is ready to carry out.
CREATED, PLAN = "_created", "_plan"


class Files:
    """The few file operations needed, on whatever file system the path names."""

    def __init__(self, spark: SparkSession):
        self._gateway, self._conf = spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _of(self, path: str):
        p = self._hadoop.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._of(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """What is directly in a folder, in order of name; nothing if there is none."""
        fs, p = self._of(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._of(path)
        fs.delete(p, True)

    def move(self, old: str, new: str) -> bool:
        """Rename in one step; False, and nothing done, if there is something of the new name."""
        fs, p = self._of(old)
        to = self._hadoop.Path(new)
        fs.mkdirs(to.getParent())
        options = getattr(self._hadoop, "Options$Rename")
        none = self._gateway.new_array(options, 1)
        none[0] = options.NONE
        context = self._hadoop.FileContext.getFileContext(fs.makeQualified(p).toUri(), self._conf)
        try:
            context.rename(fs.makeQualified(p), fs.makeQualified(to), none)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def write(self, path: str, text: str) -> None:
        """A small file, there with all of its text or not at all."""
        fs, p = self._of(f"{path}-{uuid.uuid4().hex}")
        out = fs.create(p, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.move(str(p), path):
            raise OSError(f"{path} is there already")

    def read(self, path: str) -> str:
        fs, p = self._of(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def write_once(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create the table from the result; do nothing, not even compute it, if it is there.

    The table lives in `path`, by default a folder of its name in the warehouse. It is written beside
    that, marked as finished with a file of its own (whatever Spark's committer leaves), and published by
    one rename that fails if the name is taken; the catalog entry comes last. So a run that dies half-way
    leaves nothing in the place and is repeated by the next one, and of two runs at a time the one that
    publishes second throws its work away.

    What is there counts as finished if it has the marker or a `_SUCCESS`, or if the catalog knows the table
    by that place. Only its entry is added where that is missing. Another folder is what an unfinished
    write has left: it is replaced. A table that the catalog knows in another place is kept too.
    """
    spark, files = df.sparkSession, Files(df.sparkSession)
    if path is None:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}"
    path = path.rstrip("/")
    known = spark.catalog.tableExists(table)
    if known:
        location = spark.sql(f"describe formatted {table}").where("col_name = 'Location'").first()
        if location is None or files.exists(location.data_type):
            return
        spark.sql(f"drop table {table}")  # its folder is gone
    if not _finished(files, path):
        _create(files, path, df.write.parquet)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"create table if not exists {table} ({columns}) using parquet location {quoted(path)}")


def _finished(files: Files, path: str) -> bool:
    return files.exists(f"{path}/{CREATED}") or files.exists(f"{path}/_SUCCESS")


def _create(files: Files, path: str, write: Callable[[str], None]) -> None:
    """Write beside the path and publish, unless another run has published meanwhile."""
    parent, name = path.rsplit("/", 1)
    own = uuid.uuid4().hex
    beside, aside = f"{parent}/_writing-{name}-{own}", f"{parent}/_unfinished-{name}-{own}"
    try:
        write(beside)
        files.write(f"{beside}/{CREATED}", own)
        while not files.move(beside, path):
            if _finished(files, path):
                return
            files.move(path, aside)
            if _finished(files, aside):  # published just before it was moved away
                files.move(aside, path)
                return
    finally:
        files.delete(beside)
        files.delete(aside)


class _Swap:
    """Rows of some hours in a folder beside a table of hours, on their way into it.

    The plan, written once all rows are, names the hours and whether there are rows of them. From then on
    every step can be repeated: an hour's old rows move into the swap's folder, its new rows out of it.
    """

    def __init__(self, files: Files, table: str, name: str):
        self.files, self.table, self.folder = files, table, f"{table}/{name}"

    def ready(self, hours: Sequence[str]) -> None:
        written = set(self.files.names(self.folder))
        self.files.write(f"{self.folder}/{PLAN}", "\n".join(f"{h} {int(f'dt={h}' in written)}" for h in hours))

    def plan(self) -> dict[str, bool]:
        """Empty while the rows are still being written."""
        if not self.files.exists(f"{self.folder}/{PLAN}"):
            return {}
        lines = self.files.read(f"{self.folder}/{PLAN}").split("\n")
        return {hour: new == "1" for hour, new in (line.split(" ") for line in lines)}

    def _places(self, hour: str) -> tuple[str, str, str]:
        return f"{self.table}/dt={hour}", f"{self.folder}/dt={hour}", f"{self.folder}/_old/dt={hour}"

    def _move(self, old: str, new: str) -> None:
        if not self.files.move(old, new):
            raise OSError(f"{new} is there already")

    def forward(self) -> None:
        for hour, new in self.plan().items():
            target, staged, old = self._places(hour)
            if new and not self.files.exists(staged):
                continue  # in place
            if self.files.exists(target) and not self.files.exists(old):
                self._move(target, old)
            if new:
                self._move(staged, target)

    def back(self) -> None:
        for hour, new in self.plan().items():
            target, staged, old = self._places(hour)
            if new and not self.files.exists(staged):
                self._move(target, staged)
            if self.files.exists(old):
                self._move(old, target)

    def end(self) -> None:
        self.files.delete(f"{self.folder}/{PLAN}")
        self.files.delete(self.folder)


def recover(spark: SparkSession, path: str, hours: Sequence[str] | None = None) -> list[str]:
    """Finish the swaps that died after all their rows were written; the hours that were completed.

    With `hours`, only swaps of any of those. A swap that died earlier has changed nothing; its folder
    (`_swap-...`, which readers don't see) stays, because it can't be told from one still being written.
    """
    files, done = Files(spark), []
    for name in files.names(path):
        if not name.startswith("_swap-"):
            continue
        swap = _Swap(files, path.rstrip("/"), name)
        planned = swap.plan()
        if planned and (hours is None or planned.keys() & set(hours)):
            swap.forward()
            swap.end()
            done += planned
    return sorted(done)


def _swap_in(spark: SparkSession, path: str, hours: Sequence[str], write: Callable[[str], None]) -> None:
    path, files = path.rstrip("/"), Files(spark)
    recover(spark, path, hours)
    swap = _Swap(files, path, f"_swap-{uuid.uuid4().hex}")
    try:
        write(swap.folder)
        swap.ready(hours)
    except BaseException:
        files.delete(swap.folder)
        raise
    try:
        swap.forward()
    except Exception:
        swap.back()  # where that fails too, the next `recover` goes forward
        swap.end()
        raise
    swap.end()


def write_hour(df: DataFrame, path: str, hour: str) -> None:
    """Write one hour's result as partition `dt=<hour>`; a second run replaces that hour only.

    Also by nothing: a run without rows leaves the hour empty. The result is written beside the
    partition; then the old rows are renamed away and the new ones in, and the old ones deleted. If that
    fails, the old rows are put back; if the process dies, the next run of the hour, or `recover`, ends
    what was begun. One hour has one writer at a time. A report with an `at` column of other hours (one
    made with `until`) is refused; `write_hours` takes those.
    """
    if dict(df.dtypes).get("at") == "string":
        wrong = f"concat('write_hour: row of hour ', at, ' in {hour}')"
        checked = F.expr(f"case when at is null or substr(at, 1, {len(hour)}) = '{hour}' then at else raise_error({wrong}) end")
        df = df.withColumn("at", checked)
    _swap_in(df.sparkSession, path, [hour], lambda folder: df.write.parquet(f"{folder}/dt={hour}"))


def write_hours(df: DataFrame, path: str, start: str, until: str, at: str = "at") -> None:
    """Write the result of hours [start, until) as one job, each hour replaced as by `write_hour`.

    `at` is ISO text, of which the first 13 characters are the hour; with bounds of 10 characters the table is
    one of days. Hours without rows are emptied; a row without an hour, or of one outside the range, is an error. Once all rows are written the replacement of
    all hours goes through: after a failure by being undone, after a death by `recover` or the next run
    of any of them. Rows are dealt to files by hour, a large hour to several.
    """
    if "dt" in df.columns:
        raise ValueError("write_hours makes the column dt")
    hour = f"substr(`{at}`, 1, {len(start)})"
    wrong = f"concat('write_hours: row of hour ', coalesce(`{at}`, 'null'), ' outside {start} to {until}')"
    inside = f"case when {hour} >= {quoted(start)} and {hour} < {quoted(until)} then {hour} else raise_error({wrong}) end"
    dealt = df.withColumn("dt", F.expr(inside)).hint("rebalance", "dt")
    _swap_in(df.sparkSession, path, hours_between(start, until), lambda folder: dealt.write.partitionBy("dt").parquet(folder))


_local_folders: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in `spark.checkpoint.dir`.

    Where none is named, only a local master may use a folder of this machine, which goes when the
    process ends. The session's settings are not changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="funnelspark-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, the intermediate tables made inside. Write the job's output before that.

    Without it they stay in the shared folder for as long as the cluster keeps it. The shuffle files of
    the jobs inside go as well: executors keep those until the driver's garbage collector finds them
    unused, which in a driver with little garbage takes as long as the whole job.
    """
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield
    finally:
        _scopes[:] = [s for s in _scopes if s is not mine]  # lists compare by what is in them
        for path in mine:
            Files(spark).delete(path)
        gc.collect()
        spark._jvm.System.gc()


#: Spark's own setting for it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every job run inside go as soon as it has ended, not when the driver finds them unused.

    For steps that store a result and go on from there: a result that is run twice inside is computed twice.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def via_shared_table(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Write a result to the shared folder and read it back. This runs a job.

    The rows then no longer depend on executors staying alive, are computed once however often
    they are used, and Spark knows their true size when it plans a join with them. With `outlive` the
    table is not the innermost `intermediates` block's to remove, but that of the next one out.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if outlive else _scopes
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Up to so many rows go through one task, as by `DataFrame.limit`, whose tasks stop early.
FEW = 1000


def limited(df: DataFrame, n: int) -> DataFrame:
    """n arbitrary rows of a result, or all if it has fewer.

    `DataFrame.limit` sends what it returns through one task. More than a few rows are stored instead, at most n of
    each task, which runs a job; of the stored files those that come first are taken whole and one in part, so no
    row is moved.
    """
    if n <= FEW:
        return df.limit(n)
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = via_shared_table(df.where(in_task < n), "limited")
    files = stored.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_rows"))
    upto = F.sum("_rows").over(Window.orderBy("_file"))  # one row per file
    taken = files.select("_file", (n - (upto - F.col("_rows"))).alias("_take")).where("_take > 0")
    in_file = (F.col("_metadata.file_path") == F.col("_file")) & (F.col("_metadata.row_index") < F.col("_take"))
    return stored.join(F.broadcast(taken), in_file).select(*[F.col(f"`{c}`") for c in stored.columns])
