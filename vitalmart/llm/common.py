"""Helpers shared by the operators: tables, byte views of text batches,
prefix sums over a sorted table, connected components."""

from __future__ import annotations

import contextlib
import functools
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.session import ensure_checkpoint_dir, warehouse_path

#: Bytes of text that one numpy step works on (a longer document is one step).
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once an application
    (as ``--py-files`` does), so that jobs don't rest on their search path."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        import vitalmart

        top = os.path.dirname(os.path.abspath(vitalmart.__file__))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="vitalmart-"), "vitalmart"), "zip",
                                         os.path.dirname(top), os.path.basename(top)))
        _shipped.add(sc.applicationId)


_held = threading.local()


def saved(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder: computed once, lineage cut. It stays
    unless made within ``freed``."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint()
    if scopes := getattr(_held, "scopes", None):
        scopes[-1].append(out)
    return out


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """What this thread has ``saved`` within is deleted on leaving, so a result
    must have been written before. Yields the list of it; a table taken off the
    list stays."""
    if not hasattr(_held, "scopes"):
        _held.scopes = []
    own: list[DataFrame] = []
    _held.scopes.append(own)
    try:
        yield own
    finally:
        _held.scopes.pop()
        for df in own:
            dropped(df)


def dropped(df: DataFrame) -> None:
    """Delete the checkpoint of a ``saved`` table; harmless where it is gone."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        removed(df.sparkSession, file.get())


def only_result(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that leaves no checkpoint but its result's: a result that rests on
    others is saved itself."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with freed(spark) as own:
            out = query(spark, sf_dir)
            if own and not any(out is df for df in own):
                out = saved(out)
            own[:] = [df for df in own if df is not out]
        return out

    return run


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared checkpoint folder, deleted on leaving; what
    outlives it must be ``saved`` before."""
    path = warehouse_path(spark, "llm", uuid.uuid4().hex)
    try:
        yield path
    finally:
        removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def compact(df: DataFrame, path: str, codec: str = "zstd") -> DataFrame:
    """Write as compressed parquet under ``path`` and read back."""
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values in one array, and the n + 1 offsets (null:
    empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents that hold at most ``limit`` bytes, or one document."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), vectorised; wraps around."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(values: np.ndarray, lengths, kind) -> pa.Array:
    """One list per row out of a flat array."""
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values, kind))


def running_sums(df: DataFrame, order: list[Column | str], values: list[str]) -> DataFrame:
    """Add ``<v>_before`` for each long column v: its sum over all rows that
    come earlier in ``order``.

    Rows are range-partitioned and sorted (a hot leading key is split by the
    later ones), summed within each partition as they stream by, and written
    once; the totals of the partitions (one row each, so bounded by their
    number) become the offsets. No window over data, no key in one task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
                       + [f"`{v}_before` bigint" for v in values] + ["_pid int"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, carry = TaskContext.get().partitionId(), dict.fromkeys(values, 0)
        for batch in batches:
            cols, names = list(batch.columns), list(batch.schema.names)
            for v in values:
                own = np.asarray(batch.column(names.index(v)).fill_null(0), np.int64)
                upto = np.cumsum(own) + carry[v]
                cols.append(pa.array(upto - own, pa.int64()))
                carry[v] = int(upto[-1]) if len(upto) else carry[v]
            cols.append(pa.array(np.full(batch.num_rows, pid, np.int32)))
            yield pa.RecordBatch.from_arrays(cols, names + [f"{v}_before" for v in values] + ["_pid"])

    done = saved(ranged.mapInArrow(add, schema))
    totals = done.groupBy("_pid").agg(*[F.sum(F.coalesce(v, F.lit(0))).alias(f"_{v}") for v in values])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_{v}").over(w), F.lit(0)).alias(f"_{v}")
                                      for v in values])
    out = done.join(F.broadcast(offsets), "_pid")
    for v in values:
        out = out.withColumn(f"{v}_before", F.col(f"{v}_before") + F.col(f"_{v}"))
    return out.drop("_pid", *[f"_{v}" for v in values])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b: long): the smallest
    id reachable. Alternating large-star and small-star rounds; each keeps
    one row per edge, written to the shared folder, until nothing changes.
    Only two numbers per round reach the driver."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        pairs = e.select("a", "b") if not large else e.select("a", "b").union(e.select("b", "a"))
        least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        joined = pairs.join(least, "a")
        if large:  # every larger neighbour to the smallest one
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:  # the node and its smaller neighbours to the smallest one
            out = (joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def told(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = saved(edges.where("a <> b")
              .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = told(e)
    while before[0]:  # a round at least halves the depth, so their number is a logarithm
        e = saved(star(star(e, True), False))
        now = told(e)
        if now == before:
            break
        before = now
    own = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A mapInArrow function out of one on batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return run
