"""Parquet tables partitioned by period: read one period, replace, upsert.

Writes replace whole partitions, so building the same period again leaves the
same table. Spark stages the new files and swaps them in when the job commits,
so a lost executor only repeats its tasks and a failed job changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.scalars import all_of
from tidemark.session import buckets_for, shared_folder
from tidemark.sources.schemas import Table

# While a store writes: shuffles of the job go when it ends, as nobody reads them again.
WRITE_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Into buckets: what lies together by part of a key is not moved for a join on the whole key.
BUCKET_SETTINGS = WRITE_SETTINGS | {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
# So many files a task may hold open, so that its rows need no sort by period.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold within, and are put back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the source's rows added, replacing rows of the same key.

    One join on the key, which the target holds at most once.
    """
    new = source.withColumn("_is_new", F.lit(True)).alias("n")
    old = target.alias("o")
    same_key = all_of([F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys])
    return old.join(new, same_key, "full_outer").select(
        *[
            F.when(F.col("n._is_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
            for c in target.columns
        ]
    )


def new_folder(spark: SparkSession) -> str:
    """Folder of its own under the shared one, where all executors can write."""
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


class SnapshotStore:
    """Declared tables kept as Parquet under one shared folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    @property
    def _layout(self) -> str:
        return f"{self.folder}/layout"

    def _agreed(self, what: str, asked: int | None) -> int:
        """The number stored beside the tables, or the one asked for in a new folder."""
        try:
            rows = self.spark.read.schema(f"{what} int").json(self._layout).collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = []
        stored = rows[0][what] if rows else None
        if stored is None and asked is None:
            raise ValueError(f"{self.folder} is new: say how many {what} its tables shall have")
        if None not in (stored, asked) and stored != asked:
            raise ValueError(f"tables in {self.folder} have {stored} {what}, not {asked}")
        self._is_told = stored is not None
        return stored or asked

    def _tell(self, what: str, number: int) -> None:
        if not self._is_told:
            told = self.spark.createDataFrame([(number,)], f"{what} int")
            told.coalesce(1).write.json(self._layout)
            self._is_told = True

    def path(self, table: Table) -> str:
        return f"{self.folder}/{table.name}"

    def _files(self, table: Table, period: object = None) -> DataFrame | None:
        """The table's files, or None where nothing was written yet.

        A day or number names its folder, so only that folder is listed.
        """
        path = self.path(table)
        reader = self.spark.read.schema(table.schema).option("basePath", path)
        if isinstance(period, (date, int)):
            path = f"{path}/{table.period}={period}"
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def _rows(self, table: Table, period: object = None) -> DataFrame:
        files = self._files(table, period)
        return _no_rows(self.spark, table) if files is None else files

    def _write(self, table: Table, rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite")
        if table.period is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic")
            writer = writer.partitionBy(table.period)
        kinds = table.domains.get(table.period)
        with _set(self.spark, WRITE_SETTINGS | ({OPEN_FILES: str(len(kinds))} if kinds else {})):
            writer.parquet(self.path(table))

    def read(self, table: Table, period: object = None) -> DataFrame:
        """The table, or one period of it (a pruned read); empty if never written."""
        rows = self._rows(table, period)
        if period is not None:
            rows = rows.where(F.col(table.period) == F.lit(period))
        return rows.select(*table.schema.names)

    def _gathered(self, table: Table, rows: DataFrame) -> DataFrame:
        """Rows together by period; a period much larger than the others is split."""
        return rows.hint("rebalance", table.period)

    def replace(self, table: Table, rows: DataFrame, gather: bool = False) -> None:
        """Write rows by column name, replacing every period they contain.

        A step's rows are written as they are partitioned. Rows of many periods
        are better gathered first, so that not every task writes to every file.
        """
        rows = rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        )
        if gather and table.period is not None:
            rows = self._gathered(table, rows)
        self._write(table, rows)

    def upsert(
        self,
        table: Table,
        source: DataFrame,
        periods: Sequence[object] | None = None,
        gather: bool = False,
    ) -> None:
        """Insert or replace by the declared key, rewriting only the periods touched.

        Naming the source's periods saves finding them. Rows are gathered as by ``replace``.
        """
        target = self.read(table)
        if periods is None:
            touched = source.select(table.period).distinct()
            target = target.join(touched, table.period, "left_semi")
        else:
            target = target.where(F.col(table.period).isin(list(periods)))
        self.replace(table, upsert_rows(target, source, table.key), gather)

    def create_as(self, name: str, rows: DataFrame) -> DataFrame:
        """Store a query result as a catalog table, and read it."""
        rows.write.mode("overwrite").saveAsTable(name)
        return self.spark.table(name)

    def drop(self, table: Table) -> None:
        """Remove a table's files."""
        _remove(self.spark, self.path(table))

    def result(self, rows: DataFrame, *tables: Table) -> DataFrame:
        """Rows read from the store, kept as a checkpoint, and the store removed.

        ``tables`` are those that were written.
        """
        kept = rows.checkpoint()
        for table in tables:
            self.drop(table)
        _remove(self.spark, self.folder)
        return kept

    def handed_over(self, rows: DataFrame, table: Table, *others: Table) -> DataFrame:
        """Rows read from a plain stored table, whose files stay until the process ends.

        Nothing is copied, as ``result`` does; ``others`` are removed at once.
        """
        for other in others:
            self.drop(other)
        _remove(self.spark, self._layout)
        _file_system(self.spark, self.path(table)).deleteOnExit(_path(self.spark, self.folder))
        return rows


def _no_rows(spark: SparkSession, table: Table) -> DataFrame:
    """Rows known to be none when a step is planned, so that nothing is joined with them."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    return spark.range(1).select(*columns).where(F.lit(False))


def _path(spark: SparkSession, folder: str):  # noqa: ANN202
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)


def _file_system(spark: SparkSession, folder: str):  # noqa: ANN202
    return _path(spark, folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever it is, if it is there."""
    _file_system(spark, folder).delete(_path(spark, folder), True)


class BucketedStore(SnapshotStore):
    """Snapshot tables bucketed within each period by what steps join them on.

    A step joins the previous snapshot, which holds all history, with one period
    of facts by key. Bucketed, the snapshot is read already partitioned by key, so
    only the new facts are shuffled, and each bucket is written as one file.
    Choose ``buckets`` so that a bucket of one period fits a task. Tables without
    periods are plain.

    The number of buckets is part of what is stored: it is written beside the
    tables with the first of them and read from there ever after, whatever the
    session that opens them.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None) -> None:
        """``buckets`` is needed for a new folder; of an old one it must be its own."""
        super().__init__(spark, folder)
        # For the whole session: an insert replaces the periods it holds, no others.
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        self.buckets = self._agreed("buckets", buckets)

    def table_name(self, table: Table) -> str:
        """Name in the catalog, of the whole path, so that no two folders share one."""
        return f"{table.name}_{hashlib.sha256(self.path(table).encode()).hexdigest()}"

    def _open(self, table: Table) -> str:
        """Name of the catalog table over the folder, defined on first use."""
        name = self.table_name(table)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"PARTITIONED BY ({table.period}) "
                f"CLUSTERED BY ({', '.join(table.bucket_key)}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.path(table)}'"
            )
            if self._files(table) is not None:
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _rows(self, table: Table, period: object = None) -> DataFrame:
        if table.period is None:
            return super()._rows(table)
        if not _file_system(self.spark, self.folder).exists(_path(self.spark, self.path(table))):
            return _no_rows(self.spark, table)
        return self.spark.table(self._open(table))

    def dealt(self, table: Table, rows: DataFrame) -> DataFrame:
        """Rows dealt as the table's buckets are, to be joined with it or written to it."""
        return self._gathered(table, rows)

    def _gathered(self, table: Table, rows: DataFrame) -> DataFrame:
        """Rows together by bucket: a task then writes one file per period."""
        return rows.repartition(self.buckets, *table.bucket_key)

    def _write(self, table: Table, rows: DataFrame) -> None:
        if table.period is None:
            super()._write(table, rows)
            return
        self._tell("buckets", self.buckets)
        name = self._open(table)
        # Inserting takes columns by position, in the table's own order.
        with _set(self.spark, BUCKET_SETTINGS):
            rows.select(*self.spark.table(name).columns).write.insertInto(name, overwrite=True)

    def drop(self, table: Table) -> None:
        """Remove a table's name in the catalog and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(table)}")
        super().drop(table)


def new_store(spark: SparkSession, least: int) -> BucketedStore:
    """Store in a new folder, with more buckets than ``least`` where the input is large."""
    return BucketedStore(spark, new_folder(spark), buckets_for(spark, least))


def shelved(table: Table) -> Table:
    """The table with its keys dealt onto shelves, which it is partitioned by.

    All periods of a key stand on one shelf, so a change of a key's past rewrites
    that shelf and leaves the files of all others.
    """
    schema = StructType([*table.schema.fields, StructField("shelf", IntegerType())])
    return replace(
        table, name=f"{table.name}_shelved", schema=schema, period="shelf", joined_on=()
    )


class ShelfStore(SnapshotStore):
    """Shelved tables: keys dealt by hash onto a fixed number of shelves.

    Choose ``shelves`` so that a shelf fits a few tasks; like the number of buckets it
    is stored beside the tables and another one is refused. Numbers of shelves, never
    keys, come to the driver.
    """

    def __init__(self, spark: SparkSession, folder: str, shelves: int | None = None) -> None:
        super().__init__(spark, folder)
        self.shelves = self._agreed("shelves", shelves)

    def on_shelves(self, rows: DataFrame, *key: str) -> DataFrame:
        """Rows with the shelf of their key; those of no key have one too."""
        return rows.withColumn(
            "shelf", F.pmod(F.xxhash64(*key), F.lit(self.shelves)).cast("int")
        )

    def touched(self, rows: DataFrame) -> list[int]:
        """Shelves that the rows stand on, as many as there are shelves at most."""
        return sorted(r.shelf for r in rows.select("shelf").distinct().collect())

    def read_shelves(self, table: Table, shelves: Sequence[int]) -> DataFrame:
        """Rows of some shelves; files of the others are not listed for reading."""
        return self._rows(table).where(F.col("shelf").isin(list(shelves)))

    def rewrite(self, table: Table, rows: DataFrame, shelves: Sequence[int]) -> None:
        """Put rows in place of all that stands on the shelves; no other is touched.

        Rows may be made from what the shelves hold: that goes when the job commits.
        They are made once, in the job that writes them.
        """
        self._tell("shelves", self.shelves)
        stray = f"rows of {table.name} stand on shelves that were not named"
        named = F.when(F.col("shelf").isin(list(shelves)), F.col("shelf"))
        checked = rows.withColumn("shelf", named.otherwise(F.raise_error(F.lit(stray)).cast("int")))
        before = self._file_names(table)
        try:
            self.replace(table, checked, gather=True)
        except (PySparkException, Py4JJavaError) as error:
            if stray not in str(error):
                raise
            raise ValueError(stray) from error
        # A shelf that got no rows still has the files it had.
        stale = before & self._file_names(table)
        for shelf in set(shelves):
            if any(f"/shelf={shelf}/" in name for name in stale):
                _remove(self.spark, f"{self.path(table)}/shelf={shelf}")

    def _file_names(self, table: Table) -> set[str]:
        files = self._files(table)
        return set() if files is None else set(files.inputFiles())
