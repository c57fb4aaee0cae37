"""Lake tables on shared storage: bootstrap, append, replay-safe batch writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loghaven.schemas import TABLES

BATCH = "batch_id"
#: Below a table, the folds that are being made (``operators.maintenance.compact``).
FOLDS = "_folds"
#: Files that a task of ``write_in_place`` keeps open at once.
OPEN_FILES = 64
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir``. Only a session in one process,
    as in tests, may leave it unset and gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="loghaven-"))
    return _own_folder[0]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: computed once, and kept if an
    executor is lost."""
    folder = new_folder(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def remove(spark: SparkSession, pattern: str) -> int:
    """Delete the folders and files that match a path pattern; returns how many did."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(path) or []
    for status in found:
        files.delete(status.getPath(), True)
    return len(found)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders and files that match a path pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [status.getPath().toString() for status in found]


def qualified(spark: SparkSession, name: str) -> str:
    """A path in the form in which file listings give it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def made(spark: SparkSession, file: str) -> str:
    """The file's name, once its folder exists."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return file


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; on HDFS and local disks readers see either name, never both."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not path(source).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(source), path(target)):
        raise RuntimeError(f"{source} could not be moved to {target}")


def partition_specs(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The complete specs of a table's partitions, level by level, as the catalog has them.

    Spark's own catalog drops nothing for a spec that leaves a level out.
    """
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [dict(level.split("=", 1) for level in r["partition"].split("/")) for r in rows]


def drop_partitions(spark: SparkSession, table: str, specs: Sequence[dict[str, str]]) -> None:
    def constant(value: str) -> str:
        if value == "__HIVE_DEFAULT_PARTITION__":
            return "NULL"
        return "'" + unquote(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    for at in range(0, len(specs), 200):
        listed = [", ".join(f"`{k}` = {constant(v)}" for k, v in spec.items()) for spec in specs[at : at + 200]]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({x})" for x in listed))


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def balanced(rows: DataFrame, *columns: str) -> DataFrame:
    """Ask adaptive execution for evenly sized writers grouped by the partition columns.

    A date that holds a large share of the rows is split over several writers, and
    small dates are merged into one, so there are neither huge tasks nor tiny files.
    """
    return rows.hint("rebalance", *columns)


def write_partitioned(rows: DataFrame, path: str, partition: str, mode: str = "append") -> None:
    balanced(rows, partition).write.mode(mode).partitionBy(partition).parquet(path)


def write_in_place(rows: DataFrame, path: str, partition: str, mode: str = "append") -> None:
    """Write by partition where the rows are, for large rebuilds: nothing is shuffled or sorted.

    Each task keeps a file open for each of its dates, up to ``OPEN_FILES``; with more dates it sorts
    the rest. A date then has a file for each task, so tasks should be large.
    """
    with _open_files(rows.sparkSession):
        rows.write.mode(mode).option("compression", "zstd").partitionBy(partition).parquet(path)


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def write_batch(
    rows: DataFrame,
    path: str,
    partition: str | None,
    batch_id: int | None = None,
    replaces: Sequence[int] = (),
    in_place: bool = False,
) -> None:
    """Write micro-batches so that writing them again replaces all that they wrote before.

    The batch number is a partition column. ``rows`` may carry its own batch_id column; then
    ``replaces`` lists the batches, also those that have no rows this time. The folders of
    a batch are deleted first, so a replay with fewer dates or no rows leaves none behind.
    Large batches are written ``in_place``, as by ``write_in_place``.
    """
    if batch_id is not None:
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        replaces = (batch_id,)
    keys = [c for c in (partition, BATCH) if c is not None]
    for batch in replaces:
        remove(rows.sparkSession, f"{path}/{'*/' if partition else ''}{BATCH}={batch}")
    with _open_files(rows.sparkSession) if in_place else nullcontext():
        (
            (rows if in_place else balanced(rows, *keys))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*keys)
            .parquet(path)
        )


def _ddl(schema: T.StructType, extra: str = "") -> str:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    return ", ".join(columns + ([extra] if extra else []))


@dataclass(frozen=True)
class Lake:
    """The five tables of a database, either managed or below ``location``."""

    database: str = "siem"
    location: str | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def path(self, table: str) -> str:
        if self.location is None:
            raise ValueError("a managed lake has no paths")
        return f"{self.location}/{table}"

    def create_tables(self, spark: SparkSession) -> None:
        """Create what is missing. Existing tables and their data are left alone."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        for table, (schema, partition) in TABLES.items():
            by_batch = f"`{BATCH}` bigint" if self.location and BATCH not in schema.fieldNames() else ""
            keys = [partition] if partition else []
            keys += [BATCH] if self.location else []
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({_ddl(schema, by_batch)}) USING PARQUET"
                + (f" PARTITIONED BY ({', '.join(keys)})" if keys else "")
                + (f" LOCATION '{self.path(table)}'" if self.location else "")
            )

    def append(self, rows: DataFrame, table: str) -> None:
        """Append by column name to a managed table."""
        partition = TABLES[table][1]
        if partition:
            rows = balanced(rows, partition)
        rows.sparkSession.sql(f"INSERT INTO {self.name(table)} BY NAME SELECT * FROM {{rows}}", rows=rows)

    def write_batch(
        self, rows: DataFrame, table: str, batch_id: int | None, replaces: Sequence[int] = (), in_place: bool = False
    ) -> None:
        """Replace what a batch wrote and register its partitions in the catalog's table, if
        there is one."""
        schema, partition = TABLES[table]
        keep = [c for c in schema.fieldNames() if c != BATCH] + ([BATCH] if batch_id is None else [])
        write_batch(rows.select(*keep), self.path(table), partition, batch_id, replaces, in_place)
        self.register(rows.sparkSession, table, (batch_id,) if batch_id is not None else replaces)

    def register(self, spark: SparkSession, table: str, batches: Sequence[int]) -> None:
        """Make the partitions of some batches, and no others of theirs, known to the catalog.

        The folders of a batch are listed, not the whole table as a repair does, and what the
        catalog still has of a batch without a folder is dropped by its complete spec.
        """
        name, (_, partition) = self.name(table), TABLES[table]
        if not spark.catalog.tableExists(name):
            return
        known = [s for s in partition_specs(spark, name) if int(s[BATCH]) in {*batches}]
        drop_partitions(spark, name, known)
        for batch in batches:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/{'*/' if partition else ''}{BATCH}={batch}")
            found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
            dates = [status.getPath().getParent().getName().partition("=")[2] for status in found]
            specs = [f"{partition} = DATE '{d}', {BATCH} = {batch}" for d in dates] if partition else [f"{BATCH} = {batch}"] * len(dates)
            if specs:
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({s})" for s in specs))

    def sync(self, spark: SparkSession, table: str) -> None:
        """Make all partitions of a table known to the catalog, as after a move of its files."""
        spark.catalog.recoverPartitions(self.name(table))

    def read_batches(self, spark: SparkSession, table: str, batches: Sequence[int]) -> DataFrame:
        """What some batches wrote, with their numbers, from their folders alone."""
        schema, partition = TABLES[table]
        schema = schema if BATCH in schema.fieldNames() else T.StructType([*schema, T.StructField(BATCH, T.LongType())])
        path, level = self.path(table), "*/" if partition else ""
        found = [f for b in batches for f in folders(spark, f"{path}/{level}{BATCH}={b}")]
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", path).parquet(*found)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A table by path, in its declared columns; empty before the first write. While a fold is
        made, its files count in place of those that it replaces."""
        schema, _ = TABLES[table]
        path = self.path(table)
        try:
            rows = spark.read.schema(schema).option("basePath", path).parquet(path)
            for fold in folders(spark, f"{path}/{FOLDS}/*"):
                listed = spark.read.parquet(fold).collect()
                target = next(r["target"] for r in listed if r["target"] is not None)
                depth = target[len(qualified(spark, path)) :].count("/")  # a task names its files alike in all folders
                old = ["/".join(r["file"].split("/")[-depth:]) for r in listed if r["target"] is None]
                rows = rows.where(~F.substring_index("_metadata.file_path", "/", -depth).isin(old)).select(*schema.fieldNames())
                staged = [r["file"] for r in listed if r["target"] is not None and folders(spark, r["file"])]
                if staged:
                    base = staged[0].rsplit("/", depth)[0]
                    rows = rows.unionByName(spark.read.schema(schema).option("basePath", base).parquet(*staged).select(*schema.fieldNames()))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return rows.select(*schema.fieldNames())


def scan(spark: SparkSession, table: str, rows: int | None = None) -> DataFrame:
    """A catalog table, or its first ``rows`` rows in no particular order."""
    df = spark.table(table)
    return df if rows is None else df.limit(rows)
