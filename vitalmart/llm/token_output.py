"""Token ids as byte-plane files.

A data set is a folder with two tables. ``chunks`` holds the ids: documents
in ascending order, gathered into chunks of whole documents; a chunk's ids
are cut into blocks of a fixed size, each block transposed into byte planes
and each plane compressed by zstandard. ``index`` has one small row per
chunk: shard, place within the shard, ids before it, ids in it, documents,
first and last document, payload bytes. Both are written by Spark's writer,
since executors reach a shared store only through it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.llm.common import lists, ship, steps, text_bytes
from vitalmart.llm.tokens import encoder, planes, unplanes

CHUNK_IDS = 1 << 18


def _encoded(tokenizer: str, end_id: int | None, chunk: int):
    def run(batches):
        coder = encoder(tokenizer, end_id)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        docs, lengths, ids = [], [], []

        def emit():
            nonlocal number, first, docs, lengths, ids
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            payload, sizes = planes(flat)
            row = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([len(flat)], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int32())),
                 pa.array([payload], pa.binary())],
                ["shard", "chunk", "first", "n_ids", "doc_ids", "lengths", "sizes", "payload"])
            number, first, docs, lengths, ids = number + 1, first + len(flat), [], [], []
            return row

        held = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, off = text_bytes(batch.column(1))
            for a, b in steps(off):
                flat, n = coder.encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
                ends = np.cumsum(n)
                i = 0
                while i < b - a:  # whole documents up to a chunk's size
                    j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + chunk - held)) + 1
                    j = min(j, b - a)
                    docs += names[a + i:a + j]
                    lengths += n[i:j].tolist()
                    part = flat[ends[i] - n[i]:ends[j - 1]]
                    ids.append(part)
                    held += len(part)
                    i = j
                    if held >= chunk:
                        held = 0
                        yield emit()
        if docs:
            yield emit()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None, chunk: int = CHUNK_IDS) -> None:
    """Encode every whole text of ``docs`` (doc_id, text; null: empty) and
    write the data set, documents in ascending doc_id (null first; rows with
    one doc_id by their text)."""
    ship(docs.sparkSession)
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    ranged = (docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange(*order)
              .sortWithinPartitions("doc_id", F.xxhash64("text")))
    chunks = ranged.mapInArrow(_encoded(tokenizer, end_id, chunk),
                               "shard int, chunk int, first bigint, n_ids bigint, doc_ids array<bigint>, "
                               "lengths array<bigint>, sizes array<int>, payload binary")
    chunks.write.option("compression", "none").parquet(f"{path}/chunks")
    (docs.sparkSession.read.parquet(f"{path}/chunks")
     .select("shard", "chunk", "first", "n_ids", F.size("doc_ids").alias("n_docs"),
             F.col("doc_ids")[0].alias("first_doc"), F.element_at("doc_ids", -1).alias("last_doc"),
             F.length("payload").alias("n_bytes"))
     .write.parquet(f"{path}/index"))


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                first, n, docs, lengths, sizes, payload = (batch.column(k)[i] for k in range(6))
                ids = unplanes(payload.as_py(), sizes.values.to_numpy(), n.as_py())
                lengths = lengths.values.to_numpy()
                starts = np.cumsum(lengths) - lengths
                parts = [ids[a:a + k] for a, k in zip(starts, lengths)]
                out = [docs.values, pa.array(starts + first.as_py()), pa.array(lengths),
                       pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in parts], pa.int64())]
                if with_ids:
                    out.append(lists(ids.astype(np.int64), lengths, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), batch.column(6)[i].as_py(), np.int32)), *out],
                    ["shard", "doc_id", "at", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of a data set: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32, and the ids if asked for."""
    ship(spark)
    index = spark.read.parquet(f"{path}/index")
    # one row per shard, so bounded by the number of files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_first")))
    rows = (spark.read.parquet(f"{path}/chunks").select("first", "n_ids", "doc_ids", "lengths", "sizes", "payload", "shard")
            .mapInArrow(_read(with_ids), "shard int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
                        + ", ids array<bigint>" * with_ids))
    return (rows.join(F.broadcast(shards), "shard")
            .select("doc_id", (F.col("shard_first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                    *["ids"] * with_ids))
