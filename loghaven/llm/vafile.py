"""Exact top-k search by inner product over a vector-approximation file.

Components become integers. Equal vectors are one entry. A file of approximations holds, per block
of entries, a grid of cells in each dimension and the cell of every component, a fraction of the
exact vectors' size. Every block of queries scans all approximations, which gives an upper and a
lower bound of each score; what cannot be among the best is left behind. Then exact vectors are
read in the order of their upper bounds until the last of the best is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loghaven.lake import stored

K = 5
QUERY_MODULUS = 50
SCALE = 256
#: Cells in each dimension of a block, at most 256.
CELLS = 64
#: Entries of a block of approximations, queries of a block, blocks that a task holds at once.
BLOCK, QUERY_BLOCK, HELD = 2048, 512, 32
#: Entries read in the first round, as a multiple of k, and the growth of later rounds.
FIRST_READ, READ_GROWTH = 3, 8


def _finite(value: Column) -> Column:
    inside = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    return F.coalesce(F.forall(value, inside), F.lit(False))


def integer_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, vector (floor of scale times each component) of the rows that take part."""
    value = F.col("embedding").cast("array<double>")
    inside = lambda x: F.greatest(F.least(x, F.lit(9.2e18)), F.lit(-9.2e18))
    cell = F.transform(value, lambda x: F.floor(inside(x * F.lit(float(scale)))).cast("long"))
    return vectors.where(_finite(value)).select("vec_id", cell.alias("vector"))


def entries_of(rows: DataFrame, k: int, modulus: int) -> DataFrame:
    """place, vector, ids (its k + 1 least ids, null last), asked: one row per distinct vector.

    A vector's ids beyond the k + 1 least lose every tie, so no result can hold them. They are
    left behind before the shuffle, so a vector on a third of all rows is no large group.
    """
    order = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    least = rows.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k + 1)
    ids = least.groupBy("vector").agg(F.sort_array(F.collect_list(F.struct("turn", "vec_id"))).alias("ids"))
    asked = rows.where(_is_query(modulus)).select("vector").distinct().withColumn("asked", F.lit(True))
    both = ids.join(asked, "vector", "left")
    return both.select(
        F.monotonically_increasing_id().alias("place"), "vector", F.transform("ids", lambda x: x["vec_id"]).alias("ids"),
        F.coalesce("asked", F.lit(False)).alias("asked"),
    )


def _is_query(modulus: int) -> Column:
    return F.pmod("vec_id", F.lit(modulus)) == 0


def _matrices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """places, vectors of runs of rows of one length, at most ``most`` rows each."""
    held: dict[int, list] = {}
    for batch in batches:
        for place, vector in zip(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1), strict=True):
            x = vector.values.to_numpy(zero_copy_only=False)
            rows = held.setdefault(len(x), [])
            rows.append((place, x))
            if len(rows) == most:
                yield np.array([p for p, _ in rows], np.int64), np.stack([v for _, v in rows])
                held[len(x)] = []
    for rows in held.values():
        if rows:
            yield np.array([p for p, _ in rows], np.int64), np.stack([v for _, v in rows])


FIELDS = "kind int, block long, dim int, places binary, low binary, step binary, cells binary"


def _row(kind: int, places: np.ndarray, dim: int, low: bytes, step: bytes, cells: bytes) -> pa.RecordBatch:
    columns = [pa.array([kind], pa.int32()), pa.array([int(places[0])], pa.int64()), pa.array([dim], pa.int32())]
    columns += [pa.array([x], pa.binary()) for x in (places.tobytes(), low, step, cells)]
    return pa.RecordBatch.from_arrays(columns, ["kind", "block", "dim", "places", "low", "step", "cells"])


def approximate(vectors: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value and cell width of each dimension, and the cell of each component."""
    low = vectors.min(axis=0)
    above = vectors.astype(np.uint64) - low.astype(np.uint64)  # differences of 64-bit numbers, without overflow
    step = above.max(axis=0) // np.uint64(cells) + np.uint64(1)
    return low, step, (above // step).astype(np.uint8)


def approximation_file(entries: DataFrame, cells: int = CELLS) -> DataFrame:
    """Blocks of approximations: places, the grid of each dimension and one byte per component."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, vectors in _matrices(batches, BLOCK):
            low, step, cell = approximate(vectors, cells)
            yield _row(0, places, vectors.shape[1], low.tobytes(), step.tobytes(), cell.tobytes())

    return entries.select("place", "vector").mapInArrow(build, FIELDS)


def query_blocks(entries: DataFrame) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, vectors in _matrices(batches, QUERY_BLOCK):
            yield _row(1, places, vectors.shape[1], b"", b"", vectors.astype(np.int64).tobytes())

    return entries.where("asked").select("place", "vector").mapInArrow(build, FIELDS)


def bounds(queries: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper bound of each score (queries by entries), and how far below it the score can be (by query).

    A component x lies in [low + c * step, low + c * step + step - 1], so q * x is at most q times
    the middle plus |q| times half the width. The widths are the same for all entries of a block,
    so one matrix product serves both bounds. Doubles hold these numbers exactly up to 2^53; beyond,
    the bounds are widened by more than their error.
    """
    n = min(queries.shape[1], cells.shape[1])
    q, low, step, c = queries[:, :n].astype(np.float64), low[:n].astype(np.float64), step[:n].astype(np.float64), cells[:, :n]
    width = np.abs(q) @ (step - 1)
    upper = (q * step) @ c.T.astype(np.float64) + (q @ (2 * low + step - 1) + width)[:, None] / 2
    largest = (np.abs(q) @ (np.abs(low) + 256 * step)).max(initial=0.0)
    slack = 0.0 if largest < 2.0**50 else largest * 1e-9
    return upper + slack, width + 2 * slack


def scan(files: list[tuple], places: np.ndarray, queries: np.ndarray, best: int) -> pa.RecordBatch:
    """Per query: the ``best`` largest lower bounds among some blocks, and the entries whose upper
    bound is not below the last of them, with their upper bounds."""
    n = len(queries)
    tops, found = np.full((n, best), -np.inf), []
    for at, low, step, cells in files:
        upper, width = bounds(queries, low, step, cells)
        lower = upper - width[:, None]
        if lower.shape[1] > best:
            lower = np.partition(lower, lower.shape[1] - best, axis=1)[:, -best:]
        tops = np.sort(np.concatenate([tops, lower], axis=1), axis=1)[:, -best:]
        row, col = np.nonzero(upper >= tops[:, :1])
        found.append((row, at[col], upper[row, col]))
    row, at, upper = (np.concatenate(x) for x in zip(*found, strict=True))
    kept = upper >= tops[row, 0]
    row, at, upper = row[kept], at[kept], upper[kept]
    order = np.argsort(row, kind="stable")
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=n))].astype(np.int32)
    tops_at = np.arange(0, n * best + 1, best, dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(places, pa.int64()),
            pa.ListArray.from_arrays(tops_at, pa.array(tops.ravel(), pa.float64())),
            pa.ListArray.from_arrays(ends, pa.array(at[order], pa.int64())),
            pa.ListArray.from_arrays(ends, pa.array(upper[order], pa.float64())),
        ],
        ["query", "lower", "places", "upper"],
    )


def scanned(file: DataFrame, queries: DataFrame, best: int) -> DataFrame:
    """query, lower[], places[], upper[] of each query and group of blocks.

    A unit is a group of blocks and a slice of the queries. Its blocks come first and are held;
    the blocks of queries stream past them, so memory is bounded by HELD blocks.
    """
    spark = file.sparkSession
    groups = max(1, -(-file.count() // HELD))
    slices = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // groups))
    unit = lambda group, part: (F.col(group) * slices + F.col(part)).alias("unit")
    numbered = lambda of, salt, n: F.pmod(F.xxhash64(of, F.lit(salt)), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    names = [x.split()[0] for x in FIELDS.split(", ")]
    left = file.withColumn("group", numbered("block", 1, groups)).withColumn("slice", each(slices)).select(unit("group", "slice"), *names)
    right = queries.withColumn("slice", numbered("block", 2, slices)).withColumn("group", each(groups)).select(unit("group", "slice"), *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, files = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["unit"] != unit:
                    unit, files = r["unit"], []
                places = np.frombuffer(r["places"], np.int64)
                if r["kind"] == 0:
                    grid = np.frombuffer(r["low"], np.int64), np.frombuffer(r["step"], np.uint64)
                    files.append((places, *grid, np.frombuffer(r["cells"], np.uint8).reshape(len(places), r["dim"])))
                elif files:
                    yield scan(files, places, np.frombuffer(r["cells"], np.int64).reshape(len(places), r["dim"]), best)

    both = left.unionByName(right).repartition(groups * slices, "unit").sortWithinPartitions("unit", "kind")
    return both.mapInArrow(run, "query long, lower array<double>, places array<long>, upper array<double>")


def exact_score(a: Column, b: Column) -> Column:
    """Inner product over the common components. Sums that pass 64 bits on the way are taken in
    double precision and stop at the ends of a long."""
    n = F.least(F.size(a), F.size(b))
    a, b = F.slice(a, 1, n), F.slice(b, 1, n)
    whole = F.aggregate(F.zip_with(a, b, lambda x, y: F.try_multiply(x, y)), F.lit(0).cast("long"), lambda s, x: F.try_add(s, x))
    rough = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(whole, F.greatest(F.least(rough, F.lit(9.2e18)), F.lit(-9.2e18)).cast("long"))


def best_of(entries: DataFrame, candidates: DataFrame, best: int) -> DataFrame:
    """query, best[] (worse: minus the score, then id, null last): the first ``best`` rows of each query.

    Candidates carry their turn in the order of their upper bounds. Each round reads the exact
    vectors of the next turns, of queries whose last result an unread entry could still pass.
    """
    exact = entries.select("place", "vector", "ids")
    asked = entries.select(F.col("place").alias("query"), F.col("vector").alias("asked_vector"))
    order = Window.partitionBy("query").orderBy("worse", "unnamed", "vec_id", "place")
    results, done, to = None, 0, FIRST_READ * best
    while True:
        turns = candidates.where((F.col("turn") > done) & (F.col("turn") <= to))
        if results is not None:
            last = results.groupBy("query").agg(F.max(F.when(F.col("rank") == best, -F.col("worse"))).alias("last"))
            turns = turns.join(last, "query", "left").where(F.col("last").isNull() | (F.col("upper") >= F.col("last"))).drop("last")
            rest = candidates.where(F.col("turn") > done).join(last, "query", "left")
            if rest.where(F.col("last").isNull() | (F.col("upper") >= F.col("last"))).isEmpty():
                return results
        read = turns.select("query", "place").join(exact, "place").join(asked, "query")
        read = read.select("query", "place", (-exact_score(F.col("asked_vector"), F.col("vector"))).alias("worse"), F.explode("ids").alias("vec_id"))
        read = read.withColumn("unnamed", F.col("vec_id").isNull())
        if results is not None:
            read = read.unionByName(results.drop("rank"))
        results = stored(read.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best), "va-best")
        done, to = to, to * READ_GROWTH


def top_k(vectors: DataFrame, k: int = K, modulus: int = QUERY_MODULUS, scale: int = SCALE, cells: int = CELLS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query.

    Queries are the rows whose vec_id ``modulus`` divides, against every row but their own; ties go
    to the smaller vec_id, a null one last. Vectors that are null or hold null or non-finite
    components take no part; those of different lengths are compared over their common components,
    an empty one scores 0. Repeated rows are rows of their own: each asks and is found. Fewer than
    k other rows give all of them; an empty table gives no rows. Other columns are not read.
    """
    rows = integer_rows(vectors, scale)
    entries = stored(entries_of(rows, k, modulus), "va-exact")
    file = stored(approximation_file(entries, cells), "va-cells")
    hits = stored(scanned(file, query_blocks(entries), k + 1), "va-bounds")
    by_bound = Window.partitionBy("query").orderBy(F.col("bound").desc())
    bound = hits.select("query", F.explode("lower").alias("bound")).withColumn("at", F.row_number().over(by_bound)).where(F.col("at") <= k + 1)
    bound = bound.groupBy("query").agg(F.min("bound").alias("bound"))  # minus infinity with fewer entries
    pairs = hits.select("query", F.explode(F.arrays_zip("places", "upper")).alias("x")).select("query", "x.places", "x.upper")
    pairs = pairs.join(bound, "query").where("upper >= bound").select("query", F.col("places").alias("place"), "upper")
    by_upper = Window.partitionBy("query").orderBy(F.col("upper").desc(), "place")
    candidates = stored(pairs.withColumn("turn", F.row_number().over(by_upper)), "va-candidates")
    best = best_of(entries, candidates, k + 1)
    found = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "place", "vec_id", "worse"))).alias("best"))
    asked = rows.where(_is_query(modulus)).select(F.col("vec_id").alias("query_id"), "vector")
    asked = asked.join(entries.where("asked").select("vector", F.col("place").alias("query")), "vector").drop("vector")
    own = lambda x: (x["place"] == F.col("query")) & x["vec_id"].eqNullSafe(F.col("query_id"))
    all_of = asked.join(found, "query").withColumn("own", F.array_position(F.transform("best", own), F.lit(True)))
    others = F.slice(F.filter("best", lambda x, i: i + 1 != F.col("own")), 1, k)
    return all_of.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.worse")).alias("score")
    )
