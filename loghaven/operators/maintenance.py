"""Upkeep of date-partitioned tables: compaction, layout for pruning, retention."""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.functions.once import evaluate_once
from loghaven.lake import BATCH, FOLDS, Lake, drop_partitions, folders, made, move, partition_specs, qualified, remove
from loghaven.schemas import TABLES

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Up to so many quantiles a rank is written out as comparisons in generated code.
UNROLLED_MARKS = 63


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the table's data files, from the file listing alone."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(path).select("path", "length")


def file_stats(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Files and bytes per partition value; no file is opened."""
    value = F.regexp_extract("path", f"/{partition}=([^/]+)/", 1)
    return table_files(spark, path).groupBy(value.alias(partition)).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


def fingerprint(rows: DataFrame) -> DataFrame:
    """Row count and an order-free hash of the content."""
    return rows.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(20,0)")).alias("h"),
    )


def sorted_for_pruning(rows: DataFrame, by: Sequence[str], files: int) -> DataFrame:
    """Range-partition and sort, so that the min/max of each row group is narrow.

    A hash of the row breaks ties, so one value with many rows spreads over files.
    """
    tie = F.xxhash64(*rows.columns)
    return (
        rows.withColumn("_tie", tie)
        .repartitionByRange(files, *by, "_tie")
        .sortWithinPartitions(*by, "_tie")
        .drop("_tie")
    )


def interleaved(rows: DataFrame, columns: Sequence[Column], bits: int = 5) -> Column:
    """A number whose bits are by turns those of the columns' ranks, so that rows near each other in
    all columns get near numbers.

    A rank is the place among 2^bits quantiles of the column, which one aggregate over the rows
    gives, so a column of any spread or type that orders as a number uses all of its bits. It stands
    once in the number: as plain comparisons while they are few, whose count picks the spread bits.
    """
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    marks = rows.agg(*[F.percentile_approx(c.cast("double"), share, 10_000).alias(f"m{i}") for i, c in enumerate(columns)]).first()

    def rank(column: Column, own: list[float]) -> Column:
        value = column.cast("double")
        if len(own) <= UNROLLED_MARKS:
            return reduce(add, [F.when(F.lit(m) < value, 1).otherwise(0) for m in own])
        return F.coalesce(F.size(F.filter(F.array(*map(F.lit, own)), lambda m: m < value)), F.lit(0))

    out = F.lit(0).cast("long")
    for i, column in enumerate(columns):
        own = list(marks[i] or [])
        if own:
            spread = [sum((r >> bit & 1) << (bit * len(columns) + i) for bit in range(bits)) for r in range(len(own) + 1)]
            out = out + F.get(F.array(*[F.lit(x).cast("long") for x in spread]), rank(column, own))
    return out


def sorted_by_all(rows: DataFrame, columns: Sequence[Column], files: int, bits: int = 5) -> DataFrame:
    """Rows in files that are narrow in each of several columns, not in the first alone."""
    names = [f"_v{i}" for i in range(len(columns))]
    valued = evaluate_once(rows, {n: c.cast("double") for n, c in zip(names, columns)})
    number = interleaved(rows.select(*[c.alias(n) for n, c in zip(names, columns)]), [F.col(n) for n in names], bits)
    placed = evaluate_once(valued, {"_z": number}).drop(*names)
    return sorted_for_pruning(placed, ["_z"], files).drop("_z")


def compact(
    spark: SparkSession, path: str, partition: str, value: str, staging: str,
    by: Sequence[str] = (), target_bytes: int = TARGET_FILE_BYTES, closed_batch: int | None = None,
) -> int:
    """Rewrite one closed partition into files of about ``target_bytes``; returns their number.

    Further levels of partitions stay as they are, but ``closed_batch`` folds all batches up
    to that number into the least of them, whose folder then holds their rows. Such a batch is
    never replayed, so nothing overwrites them. The new files are first written to ``staging``
    (on the same file system) and compared with the old content. Then a fold is recorded below
    the table, the new files are moved in, the old ones removed and the record taken away.
    While it stands, ``Lake.read`` leaves out the old files and adds the staged ones, so at every
    step it sees each row once; ``resume`` ends a fold that a lost job left behind.
    """
    resume(spark, path)
    table = spark.read.option("basePath", path).parquet(path)
    own = F.col(partition) == F.lit(value).cast(table.schema[partition].dataType)
    if closed_batch is not None:
        own = own & (F.col(BATCH) <= closed_batch)
    old = table.filter(own)
    files = table_files(spark, path).filter(F.col("path").contains(f"/{partition}={value}/"))
    if closed_batch is not None:
        files = files.filter(F.regexp_extract("path", f"/{BATCH}=([0-9]+)/", 1).cast("bigint") <= closed_batch)
    listed = files.collect()
    if not listed:
        return 0
    n = max(1, -(-sum(r["length"] for r in listed) // target_bytes))
    levels = re.findall("([^/=]+)=[^/]+", listed[0]["path"].rsplit("/", 1)[0][len(qualified(spark, path)) :])
    if closed_batch is not None:
        least = old.agg(F.min(BATCH)).first()[0]
        old = old.withColumn(BATCH, F.lit(least).cast(table.schema[BATCH].dataType))
    rows = sorted_for_pruning(old, by, n) if by else old.repartition(n)
    rows.write.mode("errorifexists").partitionBy(*levels).parquet(staging)
    staged = spark.read.schema(old.schema).option("basePath", staging).parquet(staging)
    if fingerprint(staged).first() != fingerprint(old).first():
        raise RuntimeError(f"compaction of {partition}={value} changed the content; see {staging}")
    record_fold(spark, path, staging, [r["path"] for r in listed])
    resume(spark, path)
    return n


def record_fold(spark: SparkSession, path: str, staging: str, old: Sequence[str]) -> None:
    """From here on the files in ``staging`` count as the table's in place of the old ones."""
    new = [r["path"] for r in table_files(spark, staging).collect()]
    home, base = qualified(spark, path), qualified(spark, staging)
    rows = [(file, home + file[len(base) :]) for file in new] + [(file, None) for file in old]
    name = uuid.uuid4().hex
    spark.createDataFrame(rows, "file string, target string").coalesce(1).write.parquet(f"{path}/{FOLDS}/.{name}")
    move(spark, f"{path}/{FOLDS}/.{name}", f"{path}/{FOLDS}/{name}")


def resume(spark: SparkSession, path: str) -> int:
    """End the folds recorded below a table: move what is still staged, remove the old files, then
    the records. Each step can be taken again. Returns the number of folds."""
    found = folders(spark, f"{path}/{FOLDS}/*")
    for fold in found:
        rows = spark.read.parquet(fold).collect()
        for r in rows:
            if r["target"] is not None and folders(spark, r["file"]):
                move(spark, r["file"], made(spark, r["target"]))
        for r in rows:
            if r["target"] is None:
                remove(spark, r["file"])
        remove(spark, fold)
        for folder in {r["file"].rsplit("/", 1)[0] for r in rows if r["target"] is None}:
            if not folders(spark, f"{folder}/*.parquet"):
                remove(spark, folder)
    return len(found)


def fold_batches(
    spark: SparkSession, lake: Lake, table: str, value: str, closed_batch: int, staging: str, by: Sequence[str] = ()
) -> int:
    """``compact`` for a lake table's date; the batches folded away leave the catalog too."""
    partition = TABLES[table][1]
    n = compact(spark, lake.path(table), partition, value, staging, by, closed_batch=closed_batch)
    name = lake.name(table)
    if n and spark.catalog.tableExists(name):
        folded = [x for x in partition_specs(spark, name) if x[partition] == value and int(x[BATCH]) <= closed_batch]
        gone = [x for x in folded if not folders(spark, f"{lake.path(table)}/{partition}={value}/{BATCH}={x[BATCH]}")]
        drop_partitions(spark, name, gone)
        spark.catalog.refreshTable(name)
    return n


def _before(value: str, limit: datetime.date) -> bool:
    """Whether a partition is of an earlier date; what is no date, as of rows without one, stays."""
    try:
        return datetime.date.fromisoformat(value) < limit
    except ValueError:
        return False


def expire(spark: SparkSession, table: str, partition: str, keep_days: int, today: str) -> list[str]:
    """Drop date partitions older than ``keep_days`` before ``today``; returns their dates.

    Partitions are dropped by their complete specs, so further levels below the date go with
    it, and then the files, which a table with a location of its own would keep.
    """
    limit = datetime.date.fromisoformat(today) - datetime.timedelta(days=keep_days)
    old = [spec for spec in partition_specs(spark, table) if _before(spec[partition], limit)]
    drop_partitions(spark, table, old)
    location = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")
    gone = expire_files(spark, location, partition, keep_days, today)
    spark.catalog.refreshTable(table)
    return sorted({spec[partition] for spec in old} | {*gone})


def expire_files(spark: SparkSession, path: str, partition: str, keep_days: int, today: str) -> list[str]:
    """``expire`` for a table known by its path alone: remove the folders of earlier dates."""
    limit = datetime.date.fromisoformat(today) - datetime.timedelta(days=keep_days)
    names = {x.rstrip("/").rsplit("=", 1)[1]: x for x in folders(spark, f"{path}/{partition}=*")}
    old = sorted(value for value in names if _before(value, limit))
    for value in old:
        remove(spark, names[value])
    return old


def expire_lake(spark: SparkSession, lake: Lake, keep_days: Mapping[str, int], today: str) -> dict[str, list[str]]:
    """Retention of lake tables by their dates: table -> days to keep; returns the dates dropped."""
    out = {}
    for table, days in keep_days.items():
        partition = TABLES[table][1]
        if partition is None:
            raise ValueError(f"{table} has no date partitions")
        if spark.catalog.tableExists(lake.name(table)):
            out[table] = expire(spark, lake.name(table), partition, days, today)
        else:
            out[table] = expire_files(spark, lake.path(table), partition, days, today)
    return out
