"""Exact dedup by content sort.

Texts are normalised (blanks deleted) to bytes. Sampled splitters deal the
rows out by ranges of (first bytes, digest, row number), so that neither a
common beginning nor a large group of copies is one task, and the splitters
that pass the driver are short however long the texts are. Spark's external sort puts
equal texts side by side; a stream over each sorted partition compares every
text with its neighbour in full. A group that runs over several partitions is
joined up through their first and last texts, one row each per partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.llm.common import saved, ship, steps, text_bytes

#: Leading bytes of a normalised text that the ranges are made of.
LEAD = 32
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = text_bytes(batch.column(1))
        for a, b in steps(off):
            part, at = data[off[a]:off[b]], off[a:b + 1] - off[a]
            solid = ~_BLANK[part]
            left = np.r_[0, np.cumsum(solid)][at]
            raw = part[solid].tobytes()
            begins = np.r_[0, np.cumsum((part & 0xC0) != 0x80)]  # bytes that begin a code point
            texts = [raw[x:y] for x, y in zip(left[:-1].tolist(), left[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(begins[at]).astype(np.int64)),
                 pa.array([t[:LEAD] for t in texts], pa.binary()),
                 pa.array([sha256(t).digest() for t in texts], pa.binary()), pa.array(texts, pa.binary())],
                ["doc_id", "n_points", "lead", "digest", "body"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pid, run, place, doc_id, n_points, digest, body): runs of equal
    neighbours are numbered within the partition; of the texts only those of
    the first and of the last row are handed on."""
    pid, run, place, before, held = TaskContext.get().partitionId(), -1, 0, None, None

    def out(doc_id, n_points, digest, runs, places, bodies):
        n = len(runs)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, pid, np.int32)), pa.array(runs, pa.int64()), pa.array(places, pa.int64()),
             doc_id, n_points, digest, pa.array(bodies, pa.binary())],
            ["pid", "run", "place", "doc_id", "n_points", "digest", "body"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield held  # not the last row
        runs, bodies = [], [None] * batch.num_rows
        for i, body in enumerate(batch.column(3)):
            body = body.as_buffer()
            if before is None or not body.equals(before):
                run += 1
            if before is None:
                bodies[0] = body.to_pybytes()
            runs.append(run)
            before = body
        before = pa.py_buffer(before.to_pybytes())  # the batch can go
        places = np.arange(place, place + batch.num_rows) + (pid << 33)
        place += batch.num_rows
        last = batch.num_rows - 1
        cols = batch.column(0), batch.column(1), batch.column(2)
        if last:
            yield out(*(c.slice(0, last) for c in cols), runs[:last], places[:last], bodies[:last])
        held = out(*(c.slice(last, 1) for c in cols), runs[last:], places[last:], bodies[last:])
        held = pa.RecordBatch.from_pylist(held.to_pylist(), held.schema)
    if held is not None:
        yield held.set_column(6, "body", pa.array([before.to_pybytes()], pa.binary()))


def exact_copies(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id (the doc_id of the
    row that stays), group_size, kept, text_sha256 (hex, of the normalised
    text), n_points (code points of the original text).

    Two texts are equal when they are identical once space and tab to carriage
    return are deleted; null counts as empty, so all null, empty and blank
    texts are one group. Of equal texts the row of the most code points stays,
    then of the smallest doc_id (null last). Rows alike in all that are copies
    like others: exactly one row of a group is kept. Empty table: no rows.
    Other columns aren't read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _normalised, "doc_id bigint, n_points bigint, lead binary, digest binary, body binary").withColumn(
        "turn", F.monotonically_increasing_id())
    order = ["lead", "digest", "turn"]
    compared = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                     .select("doc_id", "n_points", "digest", "body")
                     .mapInArrow(_compared, "pid int, run bigint, place bigint, doc_id bigint, n_points bigint, "
                                            "digest binary, body binary"))

    # one row per partition that has rows: its first and last text, its last run
    ends = saved(compared.where("body IS NOT NULL").groupBy("pid")
                 .agg(F.min_by("body", "place").alias("first"), F.max_by("body", "place").alias("last"),
                      F.max("run").alias("runs")))
    order_of = Window.orderBy("pid")
    beside = ends.select("pid", "runs", F.lag("pid").over(order_of).alias("earlier"))
    here = ends.select("pid", "first")
    there = ends.select(F.col("pid").alias("earlier"), F.col("last"))
    joined = (beside.join(here, "pid").join(there, "earlier", "left")
              .select("pid", "runs", F.coalesce(F.col("first") == F.col("last"), F.lit(False)).cast("long").alias("goes_on")))
    upto = order_of.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = joined.select("pid", (F.sum(F.col("runs") + 1 - F.col("goes_on")).over(upto) - F.col("runs") - 1).alias("base"))

    # runs are counted before any shuffle; a group's runs are one row per partition
    best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")).alias("best")
    runs = saved(compared.groupBy("pid", "run").agg(best, F.count(F.lit(1)).alias("size"))
                 .join(F.broadcast(base), "pid").withColumn("id", F.col("base") + F.col("run")))
    groups = runs.groupBy("id").agg(F.min("best").alias("best"), F.sum("size").alias("group_size"))
    judged = runs.select("pid", "run", "id").join(groups, "id").drop("id")
    # by partition and run, so the rows of a large group stay as many tasks' as they were
    return (compared.drop("body").join(judged, ["pid", "run"])
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                    (F.col("place") == F.col("best.place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
                    "n_points"))


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts (see
    ``exact_copies``), all columns as they are. Of rows alike in doc_id,
    normalised text and length any one stays."""
    stays = exact_copies(docs).where("kept").select("doc_id", "text_sha256", "n_points")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("bigint").alias("own_id"), F.length(text).cast("bigint").alias("own_points"),
                       F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "").cast("binary"), 256).alias("own_sha256"))
    once = (rows.join(stays, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_sha256") == F.col("text_sha256"))
                      & (F.col("own_points") == F.col("n_points")), "left_semi")
            .dropDuplicates(["own_id", "own_sha256"]))
    return once.select("row.*")
