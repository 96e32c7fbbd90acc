"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction, the concatenation of one code word per part of the
vector: a structured random product code, so that millions of directions
need only a few short tables. A vector is list-decoded to every filter whose
score exceeds a threshold (half of the parts are combined on either side and
matched through a sorted list, so filters below the threshold aren't
visited), and always to its few best ones. Vectors that share a filter meet
and are verified in double precision.

Equal vectors are one row with a count from the start. A filter's bucket is
split into blocks; each two blocks of a bucket meet in one step, which hands
back link counts per vector and one row per linked vector, never the pairs.
A pair that shares several filters is counted at the smallest of them only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import components, lists, saved, ship

_SEED = 7919


def code_book(dim: int, words: int, parts: int = 4) -> tuple[np.ndarray, list[np.ndarray]]:
    """A random rotation, which spreads every vector over all parts, and random
    unit code words of every part, scaled so that a whole filter has length 1;
    a part of one component has two words, an empty one a single word."""
    rng = np.random.default_rng([_SEED, dim])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    out = []
    for n in (len(p) for p in np.array_split(np.arange(dim), parts)):
        w = rng.standard_normal((words, n)) if n > 1 else np.array([[1.0], [-1.0]]) if n else np.zeros((1, 0))
        out.append(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12) * np.sqrt(n / dim))
    return rotation, out


def decode(x: np.ndarray, rotation: np.ndarray, book: list[np.ndarray], steep: float, least: int) -> np.ndarray:
    """Filters of one unit vector: all whose score is ``steep`` standard
    deviations of a random score (1 / sqrt(dim)) or more; where these are
    fewer than ``least``, the ``least`` best. Ascending."""
    cuts = np.cumsum([b.shape[1] for b in book])[:-1]
    scores = [b @ p for b, p in zip(book, np.split(rotation @ x, cuts))]
    left = (scores[0][:, None] + scores[1]).ravel()
    right = (scores[2][:, None] + scores[3]).ravel()
    order = np.argsort(-right, kind="stable")
    ranked = -right[order]
    threshold = steep / np.sqrt(len(x))
    wanted = min(least, len(left) * len(right))
    n = np.searchsorted(ranked, left - threshold, side="right")  # right scores that suffice for each left
    few = n.sum() < wanted
    while n.sum() < wanted:
        threshold -= 0.02
        n = np.searchsorted(ranked, left - threshold, side="right")
    a = np.repeat(np.arange(len(left)), n)
    b = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    found = a * len(right) + b
    if few:
        found = found[np.argsort(-(left[a] + right[b]), kind="stable")[:wanted]]
    return np.sort(found)


def _decoded(words: int, steep: float, least: int):
    def run(batches):
        books: dict[int, tuple] = {}
        for batch in batches:
            out, packed, n = [], [], []
            for v in batch.column(2):
                own = np.asarray(v.values)
                packed.append(own.tobytes())
                x = own.astype(np.float64)
                norm = np.sqrt((x * x).sum())
                if not (np.isfinite(norm) and norm > 0) or len(x) == 0:
                    x = x / max(np.abs(x).max(initial=0), 5e-324)  # tiny or huge components
                    norm = np.sqrt((x * x).sum())
                if len(x) not in books:
                    books[len(x)] = code_book(len(x), words)
                f = decode(x / norm, *books[len(x)], steep, least)
                out.append(f), n.append(len(f))
            flat = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array([len(v) for v in batch.column(2)], pa.int32()),
                 pa.array(packed, pa.binary()), lists(flat, n, pa.int64())],
                ["rep", "times", "label", "dim", "packed", "filters"])

    return run


def _met(least_cosine: float, kind: str):
    def solve(rows, cell_filter):
        ids = np.array([r[0] for r in rows], np.int64)
        x = np.frombuffer(b"".join([r[2] for r in rows]), kind).reshape(len(rows), -1).astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        rough = (x @ x.T) / (norm[:, None] * norm[None, :])
        i, j = np.nonzero(np.triu(rough >= least_cosine - 1e-9, 1))
        c = (x[i] * x[j]).sum(axis=1) / (norm[i] * norm[j])
        i, j = i[c >= least_cosine], j[c >= least_cosine]
        side = np.array([r[4] for r in rows])
        across = (side[i] == -1) | (side[i] != side[j])  # pairs of one block are another cell's
        i, j = i[across], j[across]
        # pairs that share a smaller filter are counted there
        smaller = [f[f < cell_filter] for f in (r[3] for r in rows)] if len(i) else []
        names = np.unique(np.concatenate(smaller)) if smaller else ()
        if len(names):
            has = np.zeros((len(rows), len(names)), np.float32)
            has[np.repeat(np.arange(len(rows)), [len(f) for f in smaller]), np.searchsorted(names, np.concatenate(smaller))] = 1
            shared = np.zeros(len(i), bool)
            for a in range(0, len(i), 1 << 16):
                shared[a:a + (1 << 16)] = (has[i[a:a + (1 << 16)]] * has[j[a:a + (1 << 16)]]).any(axis=1)
            i, j = i[~shared], j[~shared]
        if not len(i):
            return ids[:0], ids[:0], ids[:0]
        times = np.array([r[1] for r in rows], np.int64)
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, i, times[j])
        np.add.at(links, j, times[i])
        label = np.arange(len(rows))
        order = np.argsort(ids)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        label = rank.copy()
        while True:
            new = label.copy()
            np.minimum.at(new, i, label[j])
            np.minimum.at(new, j, label[i])
            if (new == label).all():
                break
            label = new
        at = np.flatnonzero(links)
        return ids[at], links[at], ids[order][label[at]]

    def run(batches):
        cell, rows, cell_filter = None, [], None
        for batch in batches:
            out = [], [], []
            columns = [c.to_pylist() if c.type != pa.list_(pa.int64()) else [v.values.to_numpy() for v in c]
                       for c in batch.columns]
            for key, f, *row in zip(*columns):
                if key != cell:
                    if len(rows) > 1:
                        for o, v in zip(out, solve(rows, cell_filter)):
                            o.append(v)
                    cell, rows, cell_filter = key, [], f
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *o])) for o in out],
                                             ["rep", "links", "low"])
        if len(rows) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in solve(rows, cell_filter)], ["rep", "links", "low"])

    return run


def linked(vectors: DataFrame, least_cosine: float = 0.98, words: int = 32, steep: float = 4.0,
           least: int = 32, block: int = 1024) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links (other
    vectors linked directly), component_id (smallest vec_id reachable), kept.

    Two vectors are linked when their labels are equal and not null, their
    lengths are equal and their cosine is at least ``least_cosine``. Vectors
    that are null, empty or zero, or hold null or non-finite components, and
    rows without vec_id link with nothing. A repeated vec_id counts as so many
    vectors and gives as many rows, of one component. Empty table: no rows.

    Recall rests on the filters: each vector has all filters that it exceeds
    by ``steep`` deviations and at least its ``least`` best; measured in the
    tests.
    """
    ship(vectors.sparkSession)
    x = F.col("embedding")
    sound = (x.isNotNull() & (F.size(x) > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
             & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                        & (F.abs(v.cast("double")) < F.lit(float("inf"))))
             & F.exists(x, lambda v: v != 0))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding",
                          F.coalesce(sound, F.lit(False)).alias("sound"))
    good = rows.where("sound")
    by = ["label", "embedding"]
    one = saved(good.groupBy(by).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times")))
    kind = {"array<float>": "f4", "array<double>": "f8"}[dict(vectors.dtypes)["embedding"]]
    listed = saved(one.select("rep", "times", "embedding", "label").mapInArrow(
        _decoded(words, steep, least),
        f"rep bigint, times bigint, label {dict(one.dtypes)['label']}, dim int, packed binary, filters array<bigint>"))
    # two classes can share a smallest vec_id only where vec_ids repeat
    listed = listed.withColumn("key", F.xxhash64("label", "packed"))
    entries = listed.select("label", "dim", F.explode("filters").alias("f"), "key", "rep")
    shape = (entries.groupBy("label", "dim", "f").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .withColumn("blocks", F.ceil(F.col("n") / block)))
    numbered = (entries.join(shape, ["label", "dim", "f"])
                .withColumn("own", F.pmod(F.xxhash64("key", F.lit(3)), "blocks")))
    cells = (numbered.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("key", "rep", "f", F.xxhash64("label", "dim", "f", F.least("own", "other"),
                                                   F.greatest("own", "other")).alias("cell"),
                     # a cell of one block compares all of it, one of two blocks only across
                     F.when(F.col("own") == F.col("other"), -1)
                     .otherwise((F.col("own") > F.col("other")).cast("int")).alias("side")))
    full = cells.join(listed.select("key", "rep", "times", "packed", "filters"), ["key", "rep"])
    met = saved(full.select("cell", "f", "rep", "times", "packed", "filters", "side")
                .repartition("cell").sortWithinPartitions("cell")
                .mapInArrow(_met(least_cosine, kind), "rep bigint, links bigint, low bigint"))
    direct = met.groupBy("rep").agg(F.sum("links").alias("links"))
    owners = good.select("vec_id", *by).join(one, by)
    ties = owners.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    labels = components(met.select(F.col("rep").alias("a"), F.col("low").alias("b")).union(ties))
    counted = (owners.join(direct, "rep", "left")
               .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links")))
    # rows that link with nothing keep their own id
    out = counted.union(rows.where("NOT sound").select("vec_id", F.lit(0).cast("bigint").alias("n_links")))
    return saved(out.join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
                 .select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))
                 .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
