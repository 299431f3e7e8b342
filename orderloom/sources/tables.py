"""Tables kept by streaming jobs as plain Parquet.

Each batch writes its own ``batch_id=N`` folder with overwrite, so a replayed batch replaces its rows instead
of adding them. A keyed table is read as the winning row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.keyed import earliest, latest

# Parts that rows of a table with partitions are dealt into by these before small parts are joined. Dealt into a few, a part holds hundreds of days, and cut
# for its size it writes a file of every day in each piece; so fine, only a day that is large itself is cut.
DEALT = 400


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet folder, or no rows where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Commits:
    """The batches a job has finished. The marker of a batch is written last: tables that share the marker show the rows of a batch
    together or not at all."""

    path: str

    def mark(self, spark: SparkSession, batch_id: int) -> None:
        spark.range(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        _remove_older(spark, self.path, "batch", batch_id - 1)

    def last(self, spark: SparkSession) -> int:
        """The last finished batch, -1 before the first."""
        last = _last_marked(spark, self.path, "batch")
        return -1 if last is None else last


@dataclass(frozen=True)
class BatchTable:
    """Rows tagged with the batch that wrote them. With ``commits`` only those of finished batches are shown. Files are sorted by
    ``sort_by`` within a partition, so a bound on these columns skips row groups."""

    path: str
    schema: T.StructType
    partition_by: Sequence[str] = ()
    commits: Commits | None = None
    sort_by: Sequence[str] = ()

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.select(*self.schema.fieldNames())
        if self.partition_by:
            rows = rows.hint("rebalance", DEALT, *self.partition_by)
        if self.sort_by:
            rows = rows.sortWithinPartitions(*self.partition_by, *self.sort_by)
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/batch_id={batch_id}")

    def rows(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before ``before``: what a batch may look at, as a failed first
        try of the same batch can have left rows behind."""
        found = _read(spark, self.path, self._stored)
        if self.commits:
            finished = self.commits.last(spark) + 1
            before = finished if before is None else min(before, finished)
        return found if before is None else found.where(F.col("batch_id") < before)

    def next_batch(self, spark: SparkSession) -> int:
        """The number after the last batch that wrote here: where a job goes on that has lost its checkpoint."""
        last = _read(spark, self.path, self._stored).agg(F.max("batch_id")).first()[0]
        return 0 if last is None else last + 1


@dataclass(frozen=True)
class KeyedTable:
    """One row per key: the last one written, or with ``keep_first`` the smallest by ``order``."""

    path: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    keep_first: bool = False
    commits: Commits | None = None

    def _changes(self) -> BatchTable:
        return BatchTable(f"{self.path}/changes", self.schema, self.partition_by, self.commits)

    def _base(self, version: int) -> str:
        return f"{self.path}/base/version={version}"

    def _version(self, spark: SparkSession) -> int | None:
        """Latest complete base. Its marker is written after the base, so a broken compaction is not seen."""
        return _last_marked(spark, f"{self.path}/marker", "version")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self._changes().write(rows, batch_id)

    def _winners(self, rows: DataFrame) -> DataFrame:
        order = list(self.order) if self.keep_first else ["batch_id", *self.order]
        chosen = (earliest if self.keep_first else latest)(rows, self.keys, order)
        return chosen.select(*self.schema.fieldNames())

    def current(
        self,
        spark: SparkSession,
        before: int | None = None,
        where: F.Column | None = None,
        keys: DataFrame | None = None,
    ) -> DataFrame:
        """Winning rows, of the batches before ``before`` if given. ``where`` must name key or partition
        columns; it reaches the scan. ``keys`` restricts the table to the keys a batch asks for, ahead of the
        choice of winners; its columns are key or partition columns."""
        version = self._version(spark)
        rows = self._changes().rows(spark, before)
        if version is not None:
            rows = self._folded(spark, version).unionByName(rows.where(F.col("batch_id") >= version))
        if where is not None:
            rows = rows.where(where)
        if keys is not None:
            rows = rows.join(keys.distinct(), keys.columns, "left_semi")
        return self._winners(rows)

    def _folded(self, spark: SparkSession, version: int) -> DataFrame:
        """The bases up to ``version``. With partitions a base holds only those it has folded anew, and the newest of a partition counts;
        each counts as written by the last batch it has folded."""
        if not self.partition_by:
            return _read(spark, self._base(version), self.schema).withColumn("batch_id", F.lit(version - 1).cast("long"))
        stored = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        rows = _read(spark, f"{self.path}/base", stored).where(F.col("version") <= version)
        return rows.withColumn("batch_id", F.col("version") - 1).drop("version")

    def compact(self, spark: SparkSession, before: int, oldest: str | None = None) -> None:
        """Fold the changes of all batches before ``before``, which must be committed, into a base.

        A table with partitions folds only the partitions that these batches have touched; the files of all others stay as they
        are. Partitions below ``oldest`` (of the first partition column) are forgotten. Folders a newer base has replaced are removed once the base
        before this one shows the newer: a reader that began with that base still finds it and every change after it.
        """
        last = self._version(spark)
        if last is not None and last >= before:
            return
        if self.partition_by:
            new = self._changes().rows(spark, before)
            new = new if last is None else new.where(F.col("batch_id") >= last)
            touched = new.select(*self.partition_by).distinct()
            folded = self.current(spark, before, keys=touched)
            if oldest is not None:
                folded = folded.where(F.col(self.partition_by[0]) >= oldest)
            folded = folded.hint("rebalance", DEALT, *self.partition_by)
        else:
            folded = self.current(spark, before)
        folded.write.mode("overwrite").partitionBy(*self.partition_by).parquet(self._base(before))
        spark.range(1).write.mode("overwrite").parquet(f"{self.path}/marker/version={before}")
        if last is None:
            return
        _remove_older(spark, f"{self.path}/changes", "batch_id", last)
        if self.partition_by:
            _remove_replaced(spark, f"{self.path}/base", len(self.partition_by), last, oldest)
        else:
            _remove_older(spark, f"{self.path}/base", "version", last)

    def compact_every(self, spark: SparkSession, batch_id: int, batches: int, keep_days: int | None = None) -> None:
        """Called by a job ahead of its batch, when all batches before it are committed. With ``keep_days`` a table partitioned by day forgets
        the days that lie that far before the newest day of its changes."""
        if not (batches and batch_id and batch_id % batches == 0):
            return
        oldest = None
        if keep_days is not None:
            newest = self._changes().rows(spark, batch_id).agg(F.max(F.to_date(self.partition_by[0])).alias("day"))
            oldest = newest.select(F.date_sub("day", keep_days).cast("string")).first()[0]
        self.compact(spark, batch_id, oldest)


def _folders(spark: SparkSession, pattern: str) -> tuple:
    """The file system and the folders a glob finds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, [status.getPath() for status in files.globStatus(path) or []]


def _last_marked(spark: SparkSession, path: str, name: str) -> int | None:
    """The highest N of the markers ``name=N`` below ``path``. A marker counts once its file is there, which a glob tells without a
    Spark job: every batch asks several tables."""
    _, found = _folders(spark, f"{path}/{name}=*/part-*")
    return max((int(file.getParent().getName().partition("=")[2]) for file in found), default=None)


def _remove_older(spark: SparkSession, path: str, name: str, number: int) -> None:
    """Remove the folders ``name=N`` below ``path`` with N under ``number``."""
    files, folders = _folders(spark, f"{path}/{name}=*")
    for folder in folders:
        if int(folder.getName().partition("=")[2]) < number:
            files.delete(folder, True)


def _remove_replaced(spark: SparkSession, path: str, depth: int, version: int, oldest: str | None) -> None:
    """Of every partition below ``path/version=N`` remove all folders but the newest up to ``version``, and those below ``oldest``."""
    files, folders = _folders(spark, f"{path}/version=*" + "/*=*" * depth)
    listed = []
    for folder in folders:
        parts = str(folder).rpartition("/version=")[2].split("/")
        listed.append((tuple(parts[1:]), int(parts[0]), folder))
    newest: dict[tuple, int] = {}
    for partition, number, _ in listed:
        if number <= version:
            newest[partition] = max(number, newest.get(partition, number))
    for partition, number, folder in listed:
        gone = oldest is not None and partition[0].partition("=")[2] < oldest
        if gone or number < newest.get(partition, number):
            files.delete(folder, True)


def query_tables(spark: SparkSession, statement: str, **tables: KeyedTable) -> DataFrame:
    """SQL over kept tables, each named in braces: ``SELECT * FROM {users} WHERE id = 1``."""
    return spark.sql(statement, **{name: table.current(spark) for name, table in tables.items()})
