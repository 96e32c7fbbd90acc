"""Positions, dense ids and surrogate keys without a single-task window.

``with_position`` is the one primitive: rows are range-partitioned and sorted
on a total order, each partition counts its rows, the (tiny, one row per
partition) count table becomes start offsets, and every row gets
``offset + index within partition``. This is zipWithIndex expressed with
DataFrame operations: two passes over the data, no global window, and the
offsets table is bounded by the number of partitions, so broadcasting it is
safe at any data size.

The range-partitioned rows (with their partition id and row id) are written
once as a parquet table in the shared checkpoint folder and read back before
they are counted: range boundaries come from sampling, and two evaluations
over a shuffled input could sample different boundaries, so counts and rows
must come from one materialisation. Writing (rather than ``checkpoint()``)
computes the input once, and it cuts the lineage, so a lost executor
re-reads the table instead of recomputing from the source. The write runs
when ``with_position`` is called; the returned DataFrame reads the finished
table. Within ``noted_positions`` the caller learns which tables were written
and deletes them (``delete_tables``) once its result is stored; the mart does
so for every table of its own. Elsewhere they stay, like checkpoint files.
"""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.session import warehouse_path


_noted = threading.local()


@contextlib.contextmanager
def noted_positions() -> Iterator[list[str]]:
    """The paths that ``with_position`` writes in this thread meanwhile; an
    inner use has a list of its own."""
    outer = getattr(_noted, "paths", None)
    _noted.paths = []
    try:
        yield _noted.paths
    finally:
        _noted.paths = outer


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    sc = spark.sparkContext
    for path in paths:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def _order(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_position(df: DataFrame, order_by, name: str = "pos", start: int = 1,
                  partitions: int | None = None) -> DataFrame:
    """Add a dense 1-based (or ``start``-based) position along ``order_by``.

    ``order_by`` must be a total order (ties would make positions depend on
    scan order, as the auto-increment it models does).
    """
    order = _order(order_by)
    # without an explicit count the range shuffle uses spark.sql.shuffle.partitions
    # and AQE coalesces adjacent (still ordered) partitions at runtime
    ranged_in = (df.repartitionByRange(partitions, *order) if partitions
                 else df.repartitionByRange(*order))
    spark = df.sparkSession
    path = warehouse_path(spark, "positions", uuid.uuid4().hex)
    if getattr(_noted, "paths", None) is not None:
        _noted.paths.append(path)
    (ranged_in.sortWithinPartitions(*order)
     .withColumn("_pid", F.spark_partition_id())
     .withColumn("_mid", F.monotonically_increasing_id())
     .write.parquet(path))
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # window over the per-partition counts: at most `n` rows
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (out.withColumn(name, F.col("_off") + local + F.lit(start))
            .drop("_pid", "_mid", "_off"))


# Dense id by first appearance of each value along a position
def first_seen_ids(df: DataFrame, value: str, position: str, name: str = "id") -> DataFrame:
    firsts = df.groupBy(value).agg(F.min(position).alias("_first"))
    return with_position(firsts, ["_first"], name).drop("_first")


# One id per distinct name in binary (listing) order
def name_ids(df: DataFrame, value: str, name: str = "id") -> DataFrame:
    return with_position(df.select(value).distinct(), [value], name)


# Rows [start, stop) by position along one numeric key (0-based). Ranges
# of the key are counted before anything is sorted: quantiles cut the rows into
# RANGES ranges, only those that the slice overlaps are cut again, until what
# is left is a small multiple of the slice; the key's range reaches the scan
# as a filter. Per round one row a range comes to the driver.
RANGES = 200


def slice_by_ranges(df: DataFrame, key: str, start: int, stop: int, name: str = "pos",
                    most: int = 100_000) -> DataFrame:
    """``df``'s rows of these positions with their position as ``name``; NULL
    keys come first, and ``key`` must be unique for positions to be certain."""
    k = F.col(key)
    low = high = None       # keys of the rows kept: low <= key < high; NULL keys go with low None
    before, left = 0, None  # rows before them, and their number
    stop = max(start, stop)
    while True:
        part = df if low is None else df.where(k >= F.lit(low))
        part = part if high is None else part.where((k < F.lit(high)) | (k.isNull() if low is None else F.lit(False)))
        steps = [i / RANGES for i in range(1, RANGES)]
        quantiles = part.agg(F.percentile_approx(key, steps, 10_000)).first()[0] or []
        borders = sorted(set(quantiles) - ({low} if low is not None else set()))
        if not borders:
            break
        at = F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b <= k))
        found = part.groupBy(F.when(k.isNull(), 0).otherwise(at).alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = [0] * (len(borders) + 1)
        for row in found:
            counts[row["r"]] = row["n"]
        begins = [before + sum(counts[:r]) for r in range(len(counts) + 1)]
        kept = [r for r in range(len(counts)) if begins[r] < stop and begins[r + 1] > start]
        if not kept:
            part = part.limit(0)
            break
        before, rows = begins[kept[0]], begins[kept[-1] + 1] - begins[kept[0]]
        edges = [low, *borders, high]
        low, high = edges[kept[0]], edges[kept[-1] + 1]
        if rows <= max(most, 4 * (stop - start)) or rows == left:  # small enough, or one key's rows
            part = df if low is None else df.where(k >= F.lit(low))
            part = part if high is None else part.where((k < F.lit(high)) | (k.isNull() if low is None else F.lit(False)))
            break
        left = rows
    if stop - start > most:
        placed = with_position(part, [key], name, start=before)
        return placed.where((F.col(name) >= start) & (F.col(name) < stop))
    own = part.orderBy(key).offset(max(0, start - before)).limit(stop - start)
    # at most ``most`` rows: the slice itself
    return own.withColumn(name, F.row_number().over(Window.orderBy(key)).cast("bigint") + F.lit(max(before, start) - 1))
