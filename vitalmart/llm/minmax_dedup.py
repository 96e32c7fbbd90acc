"""Near-duplicate documents by min-max hashing.

Each document's set of word shingles is hashed under ``permutations``
mixings; of each both the smallest and the largest value are kept, so half
the hashing gives a signature of twice as many unbiased entries. A band takes
four entries of four different mixings (two minima, two maxima), so entries
of a band are independent. Documents with equal sets are one class from then
on; classes that share a band are candidates, and every link is confirmed on
the full sets of both texts.

Within a band's bucket the members are compared with two pivots first (the
smallest and the largest), which joins the members of a true group with work
in proportion to its size. Buckets that then still hold several components
are finished exactly: the members outside the largest component (the outer
ones) meet all members of the bucket in blocks of bounded bytes; a cell of
two blocks counts all its intersections at once in numpy and hands back one
row per linked document, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import (compact, components, lists, mix, running_sums, saved, scratch, ship, signed, steps,
                                   text_bytes)
from vitalmart.llm.shingles import set_of, shingle_sets

_SEED = 20240607
_ROWS = 4  # entries of a band


def _mixings(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def min_max(hashes: np.ndarray, times: np.ndarray, plus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of a non-empty set under every mixing."""
    low = high = None
    for a in range(0, len(hashes), 1 << 14):
        v = hashes[a:a + (1 << 14), None] * times + plus
        lo, hi = v.min(axis=0), v.max(axis=0)
        low = lo if low is None else np.minimum(low, lo)
        high = hi if high is None else np.maximum(high, hi)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One key per two mixings: their minima with the maxima of the next two."""
    n = len(low) // 2
    key = np.arange(n, dtype=np.uint64)
    for part in (low[0::2], low[1::2], np.roll(high, -2)[0::2], np.roll(high, -2)[1::2]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part)
    return key


def _signatures(shingle: int, permutations: int):
    def run(batches):
        times, plus = _mixings(permutations)
        press = zstandard.ZstdCompressor(level=1)
        with np.errstate(over="ignore"):
            for batch in batches:
                data, off = text_bytes(batch.column(1))
                for a, b in steps(off):
                    part = data[off[a]:off[b]]
                    at = off[a:b + 1] - off[a]
                    n, sigs, bands, packed = [], [], [], []
                    for i, s in enumerate(shingle_sets(part, at, shingle)):
                        n.append(len(s))
                        packed.append(press.compress(part[at[i]:at[i + 1]].tobytes()) if len(s) else b"")
                        if len(s):
                            both = np.array([mix(s).sum(), mix(s ^ np.uint64(0xA5A5A5A5)).sum()])
                            sigs.append(both.tobytes())
                            bands.append(band_keys(*min_max(s, times, plus)))
                        else:
                            sigs.append(None)
                            bands.append(np.zeros(0, np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(sigs, pa.binary()),
                         lists(signed(np.concatenate(bands)), [len(x) for x in bands], pa.int64()),
                         pa.array(packed, pa.binary())], ["doc_id", "n_shingles", "sig", "bands", "packed"])

    return run


def _confirmed(shingle: int, percent: int):
    """Pairs whose full sets are alike enough; the last left text's set is
    kept, since pairs come sorted by it."""

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        last, left = None, None
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                if (key := a[i].as_py()) != last:
                    last, left = key, set_of(unpress.decompress(x[i].as_py()), shingle)
                right = set_of(unpress.decompress(y[i].as_py()), shingle)
                if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
                    continue
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(left) + len(right) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


def _cells(members: DataFrame, rows: int = 256, size: int = 1 << 17) -> DataFrame:
    """Rows (cell, rep, packed), cells together: outer members of a bucket
    meet each other and the bucket's main component, in blocks of about
    ``rows`` members or ``size`` shingles, so that what a cell holds is
    bounded however well its texts compress."""
    members = saved(members)
    shape = members.groupBy("key", "outer").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("z"))
    blocks = F.ceil(F.greatest(F.col("n") / rows, F.col("z") / size))
    shape = (shape.groupBy("key")
             .agg(F.max(F.when(F.col("outer"), blocks)).alias("nb_outer"),
                  F.coalesce(F.max(F.when(~F.col("outer"), blocks)), F.lit(0)).alias("nb_main")))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("outer"), F.col("nb_outer")).otherwise(F.col("nb_main")))
    others = F.sequence(F.lit(0).cast("bigint"), F.col("nb_outer") - 1)
    cell = F.when(F.col("outer"), F.concat(
        F.transform(others, lambda i: F.xxhash64("key", F.lit("oo"), F.least(i, "own"), F.greatest(i, "own"))),
        F.when(F.col("nb_main") > 0, F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("nb_main") - 1, F.lit(0).cast("bigint"))),
            lambda j: F.xxhash64("key", F.lit("om"), F.col("own"), j))).otherwise(F.array().cast("array<bigint>"))))
    cell = cell.otherwise(F.transform(others, lambda i: F.xxhash64("key", F.lit("om"), i, F.col("own"))))
    return (members.join(shape, "key").withColumn("own", own)
            .select(F.explode(cell).alias("cell"), "rep", "packed")
            .repartition("cell").sortWithinPartitions("cell"))


def intersections(sets: list[np.ndarray], dense: int = 128) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted distinct hash sets.
    Hashes found in up to ``dense`` sets add their pairs one distance at a
    time; more frequent ones are columns of a 0/1 matrix product."""
    n = len(sets)
    h = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    who = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(h, kind="stable")
    h, who = h[order], who[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    length = np.diff(np.r_[first, len(h)])
    out = np.zeros((n, n), np.int32)
    m = np.repeat(length, length)
    rare = m <= dense
    left = np.arange(len(h)) - np.repeat(first, length)  # position within its run
    for k in range(1, int(length[length <= dense].max(initial=1))):
        at = np.flatnonzero(rare & (left + k < m))
        np.add.at(out, (who[at], who[at + k]), 1)
    often = np.flatnonzero(length > dense)
    for a in range(0, len(often), 1024):
        some = often[a:a + 1024]
        grid = np.zeros((n, len(some)), np.float32)
        rows = np.concatenate([who[first[c]:first[c] + length[c]] for c in some])
        grid[rows, np.repeat(np.arange(len(some)), length[some])] = 1
        out += np.triu(grid @ grid.T, 1).astype(np.int32)
    out += out.T.copy()
    return out


def _linked_in_cells(shingle: int, percent: int):
    def solve(ids, packed, unpress):
        ids, at = np.unique(np.array(ids), return_index=True)
        if len(ids) < 2:
            return ids[:0], ids[:0]
        sets = [set_of(unpress.decompress(packed[i]), shingle) for i in at]
        n = np.array([len(s) for s in sets], np.int64)
        both = intersections(sets)
        parts = [slice(k, k + 128) for k in range(0, len(ids), 128)]  # keeps temporaries small
        link = np.vstack([(100 + percent) * both[p].astype(np.int64) >= percent * (n[p, None] + n[None, :]) for p in parts])
        np.fill_diagonal(link, False)
        label = np.arange(len(ids))
        while True:  # the smallest index reachable
            least = np.concatenate([np.where(link[p], label[None, :], len(ids)).min(axis=1) for p in parts])
            new = np.minimum(label, least)
            new = new[new]
            if (new == label).all():
                break
            label = new
        far = np.flatnonzero(label != np.arange(len(ids)))
        return ids[far], ids[label[far]]

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        cell, ids, packed = None, [], []
        for batch in batches:
            a, b = [], []
            for c, i, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if c != cell:
                    x, y = solve(ids, packed, unpress)
                    a.append(x), b.append(y)
                    cell, ids, packed = c, [], []
                ids.append(i)
                packed.append(p.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (a or [[]], b or [[]])],
                                             ["a", "b"])
        x, y = solve(ids, packed, unpress)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64))], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, permutations: int = 40) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id
    (smallest doc_id reachable over links), kept.

    Links are pairs with 100 * intersection >= percent * union of the sets of
    ``shingle``-word shingles, found through ``permutations / 2`` bands (two
    sets at 80 % share none with odds of about 3e-5 at the default).
    Null or blank text: an empty set, linked with nothing. Repeated doc_ids
    are one node, and give one row each. Null doc_id: a row with component_id
    null that is kept. Empty table: no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    ship(spark)
    with scratch(spark) as path:
        rows = compact(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            _signatures(shingle, permutations),
            "doc_id bigint, n_shingles bigint, sig binary, bands array<bigint>, packed binary"), f"{path}/rows")
        named = rows.where("doc_id IS NOT NULL")
        classes = saved(named.where("sig IS NOT NULL").groupBy("sig")
                        .agg(F.min(F.struct("doc_id", "bands")).alias("r"))
                        .select("sig", F.col("r.doc_id").alias("rep"), F.col("r.bands").alias("bands")))
        # one row per band and class; buckets of one class have no pairs
        banded = classes.select("sig", "rep", F.explode("bands").alias("key"))
        # written, so that the join is between two plain shuffles, which Spark can split
        ends = saved(banded.groupBy("key").agg(F.min("sig").alias("p"), F.max("sig").alias("q")).where("p <> q"))
        buckets = saved(banded.join(ends, "key"))
        first = (buckets.select(F.explode(F.array("p", "q")).alias("a"), F.col("sig").alias("b")).where("a <> b")
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

        # packed text of each class in a bucket, by class
        wanted = buckets.select("sig", "rep").distinct()
        texts = compact(rows.select("doc_id", "sig", "packed", "n_shingles")
                        .join(wanted.withColumnRenamed("rep", "doc_id"), ["sig", "doc_id"])
                        .dropDuplicates(["sig"]).select("sig", "packed", "n_shingles"), f"{path}/texts")

        def confirm(pairs: DataFrame) -> DataFrame:
            right = texts.select(F.col("sig").alias("b"), F.col("packed").alias("y"))
            left = texts.select(F.col("sig").alias("a"), F.col("packed").alias("x"))
            both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
            return both.sortWithinPartitions("a").mapInArrow(_confirmed(shingle, percent), "a binary, b binary")

        def as_ids(links: DataFrame) -> DataFrame:
            ids = classes.select("sig", "rep")
            return (links.join(ids.select(F.col("sig").alias("a"), F.col("rep").alias("ra")), "a")
                    .join(ids.select(F.col("sig").alias("b"), F.col("rep").alias("rb")), "b")
                    .select(F.col("ra").alias("a"), F.col("rb").alias("b")))

        # a doc_id with several texts joins their classes
        of_ids = named.where("sig IS NOT NULL").select("doc_id", "sig").distinct()
        same_id = (of_ids.join(classes.select("sig", "rep"), "sig").where("doc_id <> rep")
                   .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
        first = saved(first)
        links = saved(as_ids(confirm(first)))
        # a class's smallest doc_id is a node of its own
        many = (of_ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        ties = same_id.join(many.select(F.col("doc_id").alias("a")), "a", "left_semi")
        labels = saved(components(links.union(ties)))

        placed = (buckets.select("key", "sig", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                  .select("key", "sig", "rep", F.coalesce("component", "rep").alias("c")))
        sizes = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
        open_ = (sizes.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("n", "c")).alias("m"))
                 .where("k > 1").select("key", F.col("m.c").alias("main")))
        members = (placed.join(open_, "key").join(texts, "sig")
                   .select("key", "rep", "packed", "n_shingles", (F.col("c") != F.col("main")).alias("outer")))
        more = saved(_cells(members).mapInArrow(_linked_in_cells(shingle, percent), "a bigint, b bigint"))
        labels = saved(components(links.union(ties).union(more)))

        out = (rows.select("doc_id", "n_shingles", "sig").join(classes.select("sig", "rep"), "sig", "left")
               .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("node"))
               .join(labels, "node", "left")
               .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id")))
        return saved(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80, permutations: int = 40) -> DataFrame:
    """``docs`` without the documents that are not kept, all columns as they
    are: of each component the row of the smallest doc_id (null last) stays.

    Rows of one doc_id and one text are one document, of which one row stays
    (that of the smallest hash, maps left out); rows of one doc_id and several texts, and rows without doc_id,
    are documents of their own, compared like all others. Null, empty and
    blank texts are like nothing else and stay. Empty table: no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    text_hash = F.xxhash64("text")
    plain = [F.col("row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_hash.alias("text_hash"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash.alias("text_hash")).distinct()
    shared = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if shared.limit(1).count():  # then ids don't name texts: documents are numbered, in order of their ids
        named = (running_sums(ids.withColumn("one", F.lit(1).cast("bigint")), [F.col("doc_id").asc_nulls_last(), "text_hash"], ["one"])
                 .select(F.col("doc_id").alias("its_id"), F.col("text_hash").alias("its_hash"), F.col("one_before").alias("number")))
        own = (own.join(named, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash")))
               .select("row", F.col("number").alias("doc_id"), "text"))
    kept = near_duplicates(own, shingle, percent, permutations).where("kept").select("doc_id").distinct()
    return (own.select("row", "doc_id").join(kept, "doc_id", "left_semi")
            .groupBy("doc_id").agg(F.min_by("row", F.xxhash64(*plain)).alias("row")).select("row.*"))
