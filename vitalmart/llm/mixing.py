"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue up in a shuffled but reproducible order, copy
after copy; a copy's virtual finish time is the source's words up to its end
divided by the source's target. All copies are then sorted by that time over
the cluster and the sequence is cut where the total budget is reached, which
is where every source reaches its target at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import running_sums, saved, ship

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: dict, weights: tuple = (5, 2, 1), most: float = 3) -> dict:
    """Target of every source: sources by code point (None last) get the
    weights in turn and share the sum of all sizes; none above ``most`` times
    its size, the excess reshared by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, heavy, out = float(sum(sizes.values())), float(sum(weight.values())), {}
    for s in sorted(order, key=lambda s: most * sizes[s] / weight[s]):
        out[s] = min(float(most * sizes[s]), weight[s] * left / heavy)
        left, heavy = left - out[s], heavy - weight[s]
    return out


def mixed(docs: DataFrame, weights: tuple = (5, 2, 1), most: int = 3, seed: int = 17) -> DataFrame:
    """Per row of ``docs``: doc_id, source, text_hash, size (words), source_size,
    target (of its source), copies, taken (copies * size).

    Null text: size 0, never taken. A source without a word: source_size,
    target and copies 0. Null source: a source of its own, last in order.
    Repeated rows queue one by one. Empty table: no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    sized = saved(docs.select(
        F.col("doc_id").cast("bigint"), "source", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), F.lit(1).cast("bigint").alias("one"))
        .withColumn("turn", F.xxhash64("doc_id", "text_hash", F.lit(seed))))
    # one row per source name, which the driver shares the budget out between
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    sizes = {r.source: r.n for r in totals}
    goal, budget, begin, known = targets(sizes, weights, most), sum(sizes.values()), 0, []
    for s in sorted(sizes, key=lambda s: (s is None, s or "")):
        known.append((s, begin, sizes[s], goal[s]))
        begin += sizes[s]
    names = spark.createDataFrame(known, "name string, begin bigint, source_size bigint, target double")

    queued = (running_sums(sized, [F.col("source").asc_nulls_last(), "turn", "doc_id", "text_hash"], ["size", "one"])
              .join(names, F.col("source").eqNullSafe(F.col("name")))
              .withColumn("upto", F.col("size_before") - F.col("begin") + F.col("size"))
              .drop("size_before").withColumnRenamed("one_before", "row"))
    # a source without words: size and target 0, one copy of each row, which isn't taken
    times = F.greatest(F.lit(1), F.ceil(F.try_divide(F.col("target"), F.col("source_size")))).cast("int")
    copies = (queued.withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce(times, F.lit(1)))))
              .withColumn("finish", F.coalesce(F.try_divide((F.col("copy") - 1) * F.col("source_size") + F.col("upto"),
                                                            F.col("target")), F.lit(0.0)))
              .select("row", "doc_id", "source", "text_hash", "size", "source_size", "target", "copy", "finish"))
    line = running_sums(copies, ["finish", "row", "copy"], ["size"])
    inside = (F.col("size") > 0) & (F.col("size_before") + F.col("size") <= budget)
    return (line.groupBy("row", "doc_id", "source", "text_hash", "size", "source_size", "target")
            .agg(F.sum(inside.cast("bigint")).alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")).drop("row"))


def sampled(docs: DataFrame, weights: tuple = (5, 2, 1), most: int = 3) -> DataFrame:
    """``docs`` as mixed: every document as many times as it is taken. Rows
    alike in doc_id, source and text are copies of one document, of which one
    row's other columns stay. Null texts and texts without words are never taken;
    a null doc_id is an id like others; an empty table gives no rows."""
    by = ["doc_id", "source", "text_hash"]
    times = mixed(docs, weights, most).groupBy(by).agg(F.sum("copies").cast("int").alias("times")).where("times > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("its_id"),
                       F.col("source").alias("its_source"), F.xxhash64("text").alias("its_hash"))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(by, ["its_id", "its_source", "its_hash"])]
    once = rows.dropDuplicates(["its_id", "its_source", "its_hash"]).join(times, same[0] & same[1] & same[2])
    return once.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
