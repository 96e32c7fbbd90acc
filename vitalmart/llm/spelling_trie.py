"""Spelling variants by a relational trie frontier.

All words, and all words reversed, form tries whose nodes are prefixes (by
hash) and whose edges carry the letters up to the next branching, one row per
edge: an edge table that Spark distributes, in which a long word is few edges.
States (word, position, node, edits) walk it level by level, each level a join
with the edges of their nodes. A word's states of no edit lie on its own path.
One edit is spent within an edge, in the word's second half: an edit in the
first half lies in the second half of the reversed word. From then on an edge
must match. Where a state ends together with a word, both are neighbours,
which is confirmed on the words themselves.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import compact, saved, scratch, ship

#: Of each Latin-1 byte: letters with A-Z lowered, a space for all others.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Nodes of the empty prefix in the trie of the words and of the reversed ones.
_ROOTS = 0x9E3779B97F4A7C15, 0x2545F4914F6CDD1D
#: Distinct words that a task counts before it hands them on.
_HELD = 100_000


def _counted(spoilt: int, least_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}  # in Latin-1, a byte per code point
        crc32, get = zlib.crc32, held.get

        def out():
            done = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                               pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return done

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                own = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                runs = text.encode("latin-1", "replace").translate(_LETTERS).split()  # "?" is no letter
                for run, n in Counter(runs).items():
                    if len(run) < least_points:  # no letter left out makes it longer
                        continue
                    if spoilt and (h := crc32(run if run.isascii() else run.decode("latin-1").encode(), own)) % spoilt == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                    held[run] = get(run, 0) + n
                if len(held) > _HELD:
                    yield out()
        yield out()

    return run


def counted_words(docs: DataFrame, least_points: int = 5, least_n: int = 3, spoilt: int = 97) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lowered, at least ``least_points``
    code points long and ``least_n`` times there. In about one of ``spoilt``
    pairs of document and run a letter is left out, chosen by their checksum
    (0: nowhere). Null texts have no words; a null doc_id counts as empty."""
    ship(docs.sparkSession)
    return (docs.select("doc_id", "text").mapInArrow(_counted(spoilt, least_points), "word string, n bigint")
            .where(F.length("word") >= least_points).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, way, depth, node, next code point; -1 at the end) of each prefix
    of each word (way 0) and of each reversed word (way 1)."""
    m = (1 << 64) - 1
    for batch in batches:
        letters, ids, ways, depths, nodes, nexts = 0, [], [], [], [], []

        def out():
            done = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ways, pa.int32()), pa.array(depths, pa.int32()),
                 pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(nexts, pa.int32())],
                ["id", "way", "depth", "node", "next"])
            for held in (ids, ways, depths, nodes, nexts):
                held.clear()
            return done

        for own, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for way, w in ((0, word), (1, word[::-1])):
                h = _ROOTS[way]
                for point in map(ord, w):
                    nodes.append(h), nexts.append(point)
                    h = (h ^ point) * 0xFF51AFD7ED558CCD & m
                    h ^= h >> 29
                nodes.append(h), nexts.append(-1)
                ids.extend([own] * (len(w) + 1)), ways.extend([way] * (len(w) + 1)), depths.extend(range(len(w) + 1))
            letters += len(word)
            if letters > 50_000:
                yield out()
                letters = 0
        yield out()


def _trie(words: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The edges (node, first: the label's first code point, label, n: its
    length, child, ends: the words that end at the child or null, a list, as
    node hashes may meet, nexts: bits of the letters that follow there) of both
    tries, and each word's own path (way, w, pos, node, upto, child: the path's
    next node, null at its end)."""
    named = compact(words.select(F.monotonically_increasing_id().alias("id"), "word"), f"{path}/words")
    prefixes = compact(named.mapInArrow(_prefixes, "id bigint, way int, depth int, node bigint, next int"), f"{path}/prefixes", "snappy")
    # branching prefixes, whole words, and the two roots
    nodes = compact(prefixes.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("z"), F.min("depth").alias("d"))
                    .where("a < 0 OR a <> z OR d = 0").select("node"), f"{path}/nodes")
    on = (prefixes.join(nodes, "node").groupBy("id", "way")
          .agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("on")))  # of one word: as long as it
    there = F.get("on", F.col("i") + 1)
    steps = compact(on.join(named, "id").select("way", F.when(F.col("way") == 1, F.reverse("word")).otherwise(F.col("word")).alias("w"),
                                                "on", F.posexplode("on").alias("i", "here"))
                    .select("way", "w", F.col("here.depth").alias("pos"), F.col("here.node").alias("node"),
                            there["depth"].alias("upto"), there["node"].alias("child")), f"{path}/steps", "snappy")
    label = F.substring(F.col("w"), F.col("pos") + 1, F.col("upto") - F.col("pos"))
    edges = compact(steps.where("upto IS NOT NULL").select("node", label.alias("label"), "child").distinct()
                    .withColumns({"first": F.ascii("label"), "n": F.length("label")}), f"{path}/single")
    after = edges.groupBy(F.col("node").alias("child")).agg(F.bit_or(_bit(F.col("first"))).alias("nexts"))
    whole = steps.where("upto IS NULL").groupBy(F.col("node").alias("child")).agg(F.collect_set("w").alias("ends"))
    return compact(edges.join(after, "child", "left").join(whole, "child", "left"), f"{path}/edges"), steps


def _bit(point: Column) -> Column:
    """A set of code points is the OR of their bits; other letters may share one."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), point % 64)


def _point(at: Column) -> Column:
    """The word's code point at ``at``; 0 beyond its end."""
    return F.ascii(F.substring(F.col("w"), at + 1, 1))


def _moves_on(pos: Column, point: Column) -> Column:
    """States that could neither end nor go on aren't kept."""
    goes_on = F.col("nexts").bitwiseAND(_bit(point)) != 0
    return (pos <= F.col("size")) & F.when(pos == F.col("size"), F.col("ends").isNotNull()).otherwise(goes_on)


def _moved(joined: DataFrame, pos: Column) -> DataFrame:
    return joined.select("way", "w", pos.alias("pos"), F.col("child").alias("node"), "ends", "size")


def _edited(joined: DataFrame) -> DataFrame:
    """Each state (way, w, size, pos, p0 to p2: the word's next three code
    points) over its edge with one edit within it, in up to three ways."""
    def at(more: int):
        # most labels are one letter
        single = {0: F.col("p0") != F.col("first"), -1: F.lit(True),
                  1: (F.col("p0") == F.col("first")) | (F.col("p1") == F.col("first"))}[more]
        alike = F.when(F.col("n") == 1, single).otherwise(
            F.levenshtein(F.substring(F.col("w"), F.col("pos") + 1, F.col("n") + more), F.col("label"), 1) == 1)
        pos = F.col("pos") + F.col("n") + more
        return F.when(_moves_on(pos, F.when(F.col("n") == 1, F.col(f"p{1 + more}")).otherwise(_point(pos))) & alike, pos)

    # filtered after explode: a lambda over the array would be interpreted, row by row
    return _moved(joined, F.explode(F.array(*[at(more) for more in (0, -1, 1)]))).where("pos IS NOT NULL")


def _matched(joined: DataFrame) -> DataFrame:
    """Each state (way, w, size, pos) over its edge of the same first letter
    where the others match, too."""
    pos = F.col("pos") + F.col("n")
    alike = (F.col("n") == 1) | (F.substring(F.col("w"), F.col("pos") + 1, F.col("n")) == F.col("label"))
    return _moved(joined.where(_moves_on(pos, _point(pos)) & alike), pos)


def _walked(edges: DataFrame, steps: DataFrame, path: str) -> DataFrame:
    """(way, w, other): words that one edit ends at."""
    spark, size = edges.sparkSession, F.length("w")

    def level(states: DataFrame, k: int) -> tuple[DataFrame, bool]:
        states = states.withColumn("ends", F.when(F.col("pos") == F.col("size"), F.col("ends"))).drop("size")
        done = compact(states, f"{path}/level{k}", "snappy")
        going = done.where(F.col("pos") < size).limit(1).count() > 0
        return done, going

    # the edit: only an edge that reaches into the second half can hold it, or
    # the last letter's loss at a node before the end
    half = F.when(F.col("way") == 0, F.floor(size / 2)).otherwise(F.ceil(size / 2))
    none = steps.where(F.col("upto").isNull() | (F.col("upto") >= F.least(half + 1, size - 1))).select(
        "way", "w", "pos", "node", size.alias("size"), *[_point(F.col("pos") + i).alias(f"p{i}") for i in range(3)])
    frontier, going = level(_edited(none.join(edges, "node")), 0)
    k = 0
    while going:
        k += 1
        on = frontier.where(F.col("pos") < size).drop("ends").withColumns({"size": size, "first": _point(F.col("pos"))})
        frontier, going = level(_matched(on.join(edges, ["node", "first"])), k)
    states = spark.read.parquet(*[f"{path}/level{i}" for i in range(k + 1)])
    return states.where(F.col("pos") == F.length("w")).select("way", "w", F.explode("ends").alias("other"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of distinct words of ``words`` (word; distinct,
    not null, not empty) that one inserted, deleted or replaced code point
    parts, both ways round."""
    ship(words.sparkSession)
    with scratch(words.sparkSession) as path:
        found = _walked(*_trie(words, path), path)
        turned = [F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c)) for c in ("w", "other")]
        # where node hashes meet, states may stray: the words decide
        return saved(found.select(turned[0].alias("word"), turned[1].alias("near")).distinct()
                     .where(F.levenshtein("word", "near", 1) == 1))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form: another word, more
    frequent, so there are no rings): forms followed to the last, twice as
    far in each round."""
    reached = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        far = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = saved(reached.join(far, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")))
        if not on.where("moved").limit(1).count():
            return on.select("word", "root")
        reached = on.select("word", "root")


def variants(docs: DataFrame, least_points: int = 5, least_n: int = 3, spoilt: int = 97, times: int = 2) -> DataFrame:
    """Per word of the texts of ``docs`` (doc_id, text; see ``counted_words``):
    word, form, root, n, n_near, form_n.

    form: the near word of largest n (ties: the smallest in code-point order)
    if that is at least ``times`` the word's own n, else null; root: the last
    word that forms lead to; n_near: how many words are near. Null, empty and
    blank texts have no words; repeated rows count as often as they are there;
    an empty table gives no rows. Other columns aren't read.
    """
    words = saved(counted_words(docs, least_points, least_n, spoilt))
    near = neighbours(words)
    best = (near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best")))
    joined = words.join(best, "word", "left")
    good = -F.col("best.n") >= times * F.col("n")
    judged = saved(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                 F.when(good, F.col("best.form")).alias("form"), F.when(good, -F.col("best.n")).alias("form_n")))
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"))
    return (judged.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
