"""Packing documents into sequences of a fixed window.

A document gives as many full windows as it holds and one tail. How the tails
share windows is planned on their length histogram alone (at most ``window``
numbers, whatever the corpus size): shallow combinations of lengths that fill
a window exactly are enumerated, their repeat counts solved by non-negative
least squares against the histogram, rounded down to what is there, and what
remains is packed greedily, one tail after the other, cut at window ends.
Every tail then finds its place from its rank among the tails of its length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import compact, lists, running_sums, saved, scratch, ship, steps, text_bytes
from vitalmart.llm.tokens import encoder, planes, unplanes


def combinations(hist: np.ndarray, frequent: int = 96) -> list[tuple[int, ...]]:
    """Two or three present lengths (or one, repeated) that fill the window,
    len(hist): all pairs, and triples with two of the most frequent lengths."""
    window = len(hist)
    there = np.flatnonzero(hist)
    out = {(int(a), int(window - a)) for a in there if 2 * a <= window and hist[window - a]}
    top = sorted(there[np.argsort(-hist[there], kind="stable")[:frequent]].tolist())
    for i, a in enumerate(top):
        if window % a == 0 and window // a <= 8:
            out.add((a,) * (window // a))
        for b in top[i:]:
            c = window - a - b
            if c > 0 and hist[c]:
                out.add(tuple(sorted((a, b, c))))
    return sorted(out)


def non_negative_counts(columns: list[tuple[int, ...]], hist: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """x >= 0 that minimises |A x - hist|, column k of A counting the lengths
    of columns[k]; by coordinate descent, each step exact."""
    x, rest = np.zeros(len(columns)), hist.astype(float)
    parts = [np.unique(c, return_counts=True) for c in columns]
    norms = [float((n * n).sum()) for _, n in parts]
    for _ in range(sweeps):
        moved = 0.0
        for k, (at, n) in enumerate(parts):
            new = max(0.0, x[k] + float(rest[at] @ n) / norms[k])
            if new != x[k]:
                rest[at] -= (new - x[k]) * n
                moved = max(moved, abs(new - x[k]))
                x[k] = new
        if moved < 0.01:
            break
    return x


def plan(hist: np.ndarray) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Combinations with their repeats, and what each length has left over.
    hist[l]: tails of length l, for l below the window."""
    left = hist.copy()
    columns = combinations(hist)
    x = non_negative_counts(columns, hist)
    used: dict[tuple[int, ...], int] = {}
    order = np.argsort(-x, kind="stable")
    for rounded in (True, False):  # the solution first, then whatever still fits
        for k in order:
            at, n = np.unique(columns[k], return_counts=True)
            times = int((left[at] // n).min())
            if rounded:
                times = min(times, int(x[k] + 1e-6))
            if times > 0:
                left[at] -= times * n
                used[columns[k]] = used.get(columns[k], 0) + times
    return sorted(used.items()), left


def _tables(hist: np.ndarray):
    """Per length the runs of ranks that one combination takes, as arrays:
    (length, first rank) sorted, then its first sequence, how many of the
    length one sequence holds, the offset of the first; the ranks taken; the
    stream position at which each length's left-over tails begin; sequences."""
    chosen, left = plan(hist)
    taken, sequence, runs = np.zeros(len(hist), np.int64), 0, []
    for lengths, times in chosen:
        offset = 0
        for length in sorted(set(lengths)):
            n = lengths.count(length)
            runs.append((length, int(taken[length]), sequence, n, offset))
            taken[length] += times * n
            offset += n * length
        sequence += times
    stream = np.cumsum(left * np.arange(len(hist))) - left * np.arange(len(hist))
    return np.array(sorted(runs), np.int64).reshape(-1, 5), taken, stream, sequence


def _tokenized(tokenizer: str, end_id: int | None, window: int):
    def run(batches):
        coder, row = encoder(tokenizer, end_id), TaskContext.get().partitionId() << 40
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for a, b in steps(off):
                ids, n = coder.encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
                ends = np.cumsum(n)
                packed = [planes(ids[e - k:e], level=1) for e, k in zip(ends, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(n))), batch.column(0).slice(a, b - a), pa.array(n),
                     pa.array(n // window), pa.array(n % window), pa.array(np.ones(len(n), np.int64)),
                     lists(np.concatenate([s for _, s in packed]), [len(s) for _, s in packed], pa.int32()),
                     pa.array([p for p, _ in packed], pa.binary())],
                    ["row", "doc_id", "n", "full", "tail", "one", "sizes", "packed"])
                row += len(n)

    return run


def _placed(window: int, tables, before_tails):
    """Adds each row's pieces: start, length, sequence, offset."""
    first_of_length, first_combined = before_tails

    def run(batches):
        runs, taken, stream, combined = tables.value
        keys = runs[:, 0] * (1 << 45) + runs[:, 1]
        for batch in batches:
            n, full, tail, rank, at = (np.asarray(batch.column(k), np.int64) for k in range(2, 7))
            rank = rank - first_of_length[tail]
            starts, lengths, sequences, offsets, count = [], [], [], [], []
            where = np.searchsorted(keys, tail * (1 << 45) + rank, side="right") - 1
            for i in range(batch.num_rows):
                k, t = int(full[i]), int(tail[i])
                starts += range(0, k * window, window)
                lengths += [window] * k
                sequences += range(int(at[i]), int(at[i]) + k)
                offsets += [0] * k
                pieces = k
                if t and rank[i] < taken[t]:
                    _, low, sequence, times, offset = (int(v) for v in runs[where[i]])
                    turn = int(rank[i]) - low
                    starts.append(k * window), lengths.append(t)
                    sequences.append(first_combined + sequence + turn // times)
                    offsets.append(offset + turn % times * t)
                    pieces += 1
                elif t:
                    at_stream = int(stream[t] + (rank[i] - taken[t]) * t)
                    done = 0
                    while done < t:  # cut at window ends, so once at most
                        s, o = divmod(at_stream + done, window)
                        m = min(t - done, window - o)
                        starts.append(k * window + done), lengths.append(m)
                        sequences.append(first_combined + combined + s), offsets.append(o)
                        done += m
                        pieces += 1
                count.append(pieces)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 *[lists(np.array(v, np.int64), count, pa.int64()) for v in (starts, lengths, sequences, offsets)]],
                ["row", "doc_id", "n", "starts", "lengths", "sequences", "offsets"])

    return run


def _pieces(batches):
    for batch in batches:
        out = [[] for _ in range(7)]
        for i in range(batch.num_rows):
            doc, n, starts, lengths, sequences, offsets, sizes, packed = (batch.column(k)[i].as_py() for k in range(8))
            raw = unplanes(packed, sizes, n).astype("<u4")
            for s, m, q, o in zip(starts, lengths, sequences, offsets):
                for c, v in zip(out, (doc, s, m, zlib.crc32(raw[s:s + m].tobytes()), n, q, o)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def packed(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset. Each id of each row's text (null: empty; the end id included) lies
    in one piece; sequences are gapless from 0 and numbered from 0. Only the
    last sequence of the left-over tails may fall short of the window.

    Repeated rows are packed one by one; null doc_ids stay null; an empty
    table gives no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    ship(spark)
    with scratch(spark) as path:
        rows = compact(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            _tokenized(tokenizer, end_id, window),
            "row bigint, doc_id bigint, n bigint, full bigint, tail bigint, one bigint, sizes array<int>, packed binary"),
            f"{path}/ids")
        ranked = running_sums(rows.drop("sizes", "packed"), ["tail", "row"], ["one", "full"])
        counts = ranked.groupBy("tail").agg(F.sum("one").alias("n"), F.sum("full").alias("full")).collect()
        hist, full = np.zeros(window, np.int64), 0  # at most ``window`` rows
        for r in counts:
            hist[r.tail], full = r.n, full + r.full
        first = np.cumsum(hist) - hist
        hist[0] = 0
        tables = spark.sparkContext.broadcast(_tables(hist))
        placed = (ranked.select("row", "doc_id", "n", "full", "tail", F.col("one_before").alias("rank"),
                                F.col("full_before").alias("at"))
                  .mapInArrow(_placed(window, tables, (first, full)),
                              "row bigint, doc_id bigint, n bigint, starts array<bigint>, lengths array<bigint>, "
                              "sequences array<bigint>, offsets array<bigint>"))
        joined = placed.join(rows.select("row", "sizes", "packed"), "row")
        return saved(joined.select("doc_id", "n", "starts", "lengths", "sequences", "offsets", "sizes", "packed").mapInArrow(
            _pieces, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                     "sequence_id bigint, offset bigint"))
