"""Exact top-k search by vector-approximation files.

Vectors are gathered into blocks and written twice over, in columns that are
read apart: the approximation (for every component the number of its
quantised cell, one byte, and the block's cell borders), and the exact
vectors. A scan of the cells alone bounds every score from both sides; the
k-th highest lower bound of a query over all blocks leaves few vectors whose
upper bound reaches it. Those alone are fetched and read in order of their
upper bound until the k-th best exact score is certain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.llm.common import compact, saved, scratch, ship
from vitalmart.session import scoped_conf

#: Cells of a component: what one byte numbers.
CELLS = 256
BLOCK = 4096
#: Queries of a block, and those that one numpy step bounds.
QUERIES, STEP = 1024, 128
#: Vectors with a component beyond this are in blocks of their own.
SMALL = 1 << 20
#: Sums below it are exact in doubles, halves included.
EXACT = 2.0 ** 50

_BLOCK = "number bigint, dim int, most double, ids binary, data binary, codes binary, borders binary"


def approximate(x: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers of the vectors, and the least and the largest value of
    each cell of a component: (2, cells, components). Cells begin at even
    ranks, so that one holds as many vectors as any other."""
    ranked = np.sort(x, axis=0)
    low = ranked[np.arange(cells) * len(x) // cells]
    high = np.concatenate([low[1:], ranked[-1:]])
    codes = np.empty(x.shape, np.uint8)
    for d in range(x.shape[1]):
        last = np.searchsorted(ranked[:, d], low[1:, d], side="left") - 1
        high[:-1, d] = ranked[np.maximum(last, 0), d]
        codes[:, d] = np.searchsorted(low[:, d], x[:, d], side="right") - 1
    return codes, np.stack([low, high])


def bounds(q: np.ndarray, codes: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of the inner products of all queries with all
    vectors of a block, from their cells alone: (queries, vectors). Exact for
    sums below ``EXACT``."""
    d = np.arange(codes.shape[1])
    low, high = borders[0][codes, d].astype(np.float64), borders[1][codes, d].astype(np.float64)
    middle, spread = q.astype(np.float64) @ ((low + high) / 2).T, np.abs(q).astype(np.float64) @ ((high - low) / 2).T
    return middle + spread, middle - spread


def _gather(block: int, cells: int | None):
    """Blocks of up to ``block`` vectors of one length, small ones and others
    apart; with their approximation where ``cells`` is given."""

    def run(batches):
        pid, number = TaskContext.get().partitionId(), 0
        held: dict[tuple, list] = {}

        def out(dim, rows):
            nonlocal number
            ids, x = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
            for a in range(0, len(ids), block):
                part = np.ascontiguousarray(x[a:a + block])
                codes, borders = approximate(part, cells) if cells else (part[:0], part[:0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(pid << 33) + number], pa.int64()), pa.array([dim], pa.int32()),
                     pa.array([float(np.abs(part.astype(np.float64)).max(initial=0))], pa.float64()),
                     *[pa.array([v.tobytes()], pa.binary()) for v in (ids[a:a + block], part, codes, borders)]],
                    ["number", "dim", "most", "ids", "data", "codes", "borders"])
                number += 1

        for batch in batches:
            ids, column = np.asarray(batch.column(0), np.int64), batch.column(1)
            off, values = np.asarray(column.offsets, np.int64), np.asarray(column.values, np.int64)
            lengths = np.diff(off)
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                x = values[off[at][:, None] + np.arange(dim)].reshape(-1, dim)
                large = ((x > SMALL) | (x < -SMALL)).any(axis=1)
                for kind in (False, True):
                    if (own := large == kind).any():
                        rows = held.setdefault((dim, kind), [])
                        rows.append((ids[at][own], x[own]))
                        if sum(len(i) for i, _ in rows) >= block:
                            yield from out(dim, held.pop((dim, kind)))
        for (dim, _), rows in held.items():
            yield from out(dim, rows)

    return run


def _scan(k: int, cells: int):
    """Per query the vectors of each block whose upper bound reaches the k-th
    highest lower bound of what the task has scanned so far."""

    def run(batches):
        key, qids, q, best = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                qnumber, dim, qmost, qraw, qdata, number, most, raw, code, border = (
                    batch.column(j)[i].as_py() for j in range(10))
                if qnumber != key:
                    key, qids = qnumber, np.frombuffer(qraw, np.int64)
                    q = np.frombuffer(qdata, np.int64).reshape(len(qids), dim)
                    best = np.full((len(qids), k), -np.inf)
                ids = np.frombuffer(raw, np.int64)
                codes = np.frombuffer(code, np.uint8).reshape(len(ids), dim)
                borders = np.frombuffer(border, np.int64).reshape(2, cells, dim)
                for a in range(0, len(qids), STEP):
                    some = slice(a, a + STEP)
                    if most * qmost * max(dim, 1) < EXACT:
                        upper, lower = bounds(q[some], codes, borders)
                    else:  # beyond what doubles hold: no bound
                        upper = np.full((len(qids[some]), len(ids)), np.inf)
                        lower = -upper
                    own = qids[some, None] == ids
                    upper[own] = lower[own] = -np.inf
                    best[some] = -np.partition(-np.hstack([best[some], lower]), k - 1, axis=1)[:, :k]
                    row, at = np.nonzero((upper >= best[some].min(axis=1)[:, None]) & ~own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(qids[some][row]), pa.array(np.full(len(row), number, np.int64)),
                         pa.array(at.astype(np.int32)), pa.array(upper[row, at]), pa.array(lower[row, at])],
                        ["query_id", "number", "place", "upper", "lower"])

    return run


def _fetch(batches):
    """The exact vectors at the places named, one row each."""
    for batch in batches:
        for i in range(batch.num_rows):
            number, dim, raw, data, places = (batch.column(j)[i].as_py() for j in range(5))
            ids, wide = np.frombuffer(raw, np.int64), 8 * dim
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(places), pa.int64()), pa.array(places, pa.int32()), pa.array(ids[places]),
                 pa.array([data[wide * p:wide * p + wide] for p in places], pa.binary())],
                ["number", "place", "vec_id", "data"])


def _decide(k: int):
    """The k best of every query, from rows by query and falling upper bound;
    a query's rows are read until none left can reach its k-th score."""

    def run(batches):
        now, best = None, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * len(best), pa.int64()), pa.array([i for _, i in best], pa.int64()),
                 pa.array([-s for s, _ in best], pa.int64())], ["query_id", "vec_id", "score"])

        for batch in batches:
            query, upper = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else []
            for a, b in zip(starts, [*starts[1:], len(query)]):
                if now != query[a]:
                    if best:
                        yield out()
                    now, best = int(query[a]), []
                q = np.array(batch.column(3)[int(a)].as_py(), np.int64)
                for c in range(int(a), int(b), 64):
                    if len(best) == k and upper[c] < -best[-1][0]:
                        break
                    part = slice(c, min(c + 64, int(b)))
                    ids = np.asarray(batch.column(2).slice(c, part.stop - c)).tolist()
                    x = np.frombuffer(b"".join(batch.column(4).slice(c, part.stop - c).to_pylist()), np.int64)
                    x = x.reshape(len(ids), len(q))
                    if np.isfinite(upper[part]).all():
                        scores = (x @ q).tolist()
                    else:  # whole numbers of any size, stopped at a long's ends
                        scores = [min(max(sum(s * t for s, t in zip(v, q.tolist())), -(1 << 63)), (1 << 63) - 1)
                                  for v in x.tolist()]
                    best = sorted([*best, *((-s, i) for s, i in zip(scores, ids))])[:k]
        if best:
            yield out()

    return run


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    x = F.col("embedding")
    # what a long can't hold stops at its ends; sums of such are exact integers (see _decide)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    fit = vectors.where(x.isNotNull() & F.col("vec_id").isNotNull()
                        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                                   & (F.abs(v.cast("double")) < F.lit(float("inf")))))
    return fit.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))


def survivors(blocks: DataFrame, asked: DataFrame, path: str, k: int, cells: int = CELLS) -> DataFrame:
    """(query_id, number, place, upper): the vectors whose upper bound reaches
    their query's k-th highest lower bound over all blocks. Only cells and
    borders are read."""
    few = blocks.select("number", "dim", "most", "ids", "codes", "borders")
    # every block of queries meets every block of vectors of its length once
    pairs = (few.select("dim", "number").join(asked.select("dim", F.col("number").alias("q")), "dim")
             .repartition("number", "q"))
    met = (pairs.select("number", "q").join(few, "number")
           .join(asked.select(F.col("number").alias("q"), F.col("most").alias("qmost"), F.col("ids").alias("qids"),
                              F.col("data").alias("qdata")), "q")
           .select("q", "dim", "qmost", "qids", "qdata", "number", "most", "ids", "codes", "borders"))
    with scoped_conf(blocks.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": 16}):  # rows are blocks
        found = compact(met.sortWithinPartitions("q", "number").mapInArrow(
            _scan(k, cells), "query_id bigint, number bigint, place int, upper double, lower double"), f"{path}/found")
    best = Window.partitionBy("query_id").orderBy(F.desc("lower"))
    kth = (found.select("query_id", "lower").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
           .groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("lower").alias("kth")))
    return (found.join(kth, "query_id").where((F.col("n") < k) | (F.col("upper") >= F.col("kth")))
            .select("query_id", "number", "place", "upper"))


def candidates(rows: DataFrame, k: int) -> DataFrame:
    """The rows (vec_id, v) that may be among any query's k best: of equal
    vectors, whose scores are equal, the k + 1 smallest ids (one may be the
    query's own), each up to k times. Both steps reduce before they shuffle,
    so copies of one vector are no hot key and no query meets them all."""
    smallest = Window.partitionBy("v").orderBy("vec_id")
    return (rows.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= k + 1)
            .select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
            .select("vec_id", "v"))


def indexed(rows: DataFrame, path: str, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """The vector-approximation file of ``rows`` (vec_id, v) below ``path``: a
    row per block, its cells and its exact vectors in columns of their own."""
    return compact(rows.mapInArrow(_gather(block, cells), _BLOCK), f"{path}/blocks")


def questions(rows: DataFrame, path: str) -> DataFrame:
    """Blocks of queries, exact vectors only."""
    return compact(rows.mapInArrow(_gather(QUERIES, None), _BLOCK).drop("codes", "borders"), f"{path}/asked")


def nearest(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding) with ``is_query`` the k
    rows of the highest inner product over floor(scale * x): query_id, rank
    (from 1), vec_id, score (long); ties to the smaller vec_id; rows with the
    query's own vec_id left out.

    Vectors that are null or hold null or non-finite components, and null
    vec_ids, take no part; only vectors of one length are compared. Of
    repeated vec_ids as queries one stays (the smallest vector), as candidates
    all. Components beyond 64 bits after scaling, and scores beyond them,
    stop at the largest (smallest) long. Empty table: no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    with scratch(spark) as path:
        rows = _usable(vectors, scale)
        blocks = indexed(candidates(rows, k), path, block, cells)
        own = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
        asked = questions(own, path)
        left = compact(survivors(blocks, asked, path, k, cells), f"{path}/left")
        # a block's vectors are read once, for all queries that need any of them
        needed = left.groupBy("number").agg(F.sort_array(F.collect_set("place")).alias("places"))
        with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": 16}):
            read = compact(blocks.select("number", "dim", "ids", "data").join(needed, "number").mapInArrow(
                _fetch, "number bigint, place int, vec_id bigint, data binary"), f"{path}/read")
        return _ranked(left, read, own, k)


def _ranked(left: DataFrame, read: DataFrame, own: DataFrame, k: int) -> DataFrame:
    rows = (left.join(read, ["number", "place"]).join(own.select(F.col("vec_id").alias("query_id"), "v"), "query_id")
            .select("query_id", "upper", "vec_id", "v", "data"))
    found = (rows.repartition("query_id").sortWithinPartitions("query_id", F.desc("upper"))
             .mapInArrow(_decide(k), "query_id bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return saved(found.withColumn("rank", F.row_number().over(best).cast("int"))
                 .select("query_id", "rank", "vec_id", "score"))
