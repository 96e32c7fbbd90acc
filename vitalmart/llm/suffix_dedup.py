"""Exact substring dedup over a distributed suffix array.

Every byte of a string of ``LENGTH`` bytes that also starts anywhere else is
removed. Only some suffixes need sorting: in every window of that length the
place of its smallest hashed gram depends on the window alone, so equal
windows hold the same place, and one suffix per such place (an anchor)
stands for the run of windows that chose it. An anchor's window reaches at
least half its length to one side: to the right (read forward) or to the left
(read backward), so each run is split into these two halves; the further side
is the half's main string, the nearer one its side string.

1. A hash of the first part of the main string finds the halves that any
   other half can match (an estimate of the distinguishing prefix, as in
   prefix-doubling string sorting); all others leave here.
2. Halves that are alike in their whole reach are settled by counting: all
   their windows repeat. One of each class goes on where other classes share
   its first part.
3. Their main strings are sorted: each task sends sorted, front-coded runs,
   and the receiving task merges them by a loser tree that knows each run's
   common prefix with the last string put out and compares only what lies
   beyond it.
4. The merged order gives the tree of common prefixes; along it, from the
   deepest node up, the children's lists, sorted by side string, are merged
   by the same loser tree, and a neighbour's common prefix then says which
   windows repeat: those with enough on the main side (the node's depth) and
   enough on the other (the neighbour's).

Where one first part is shared by more than ``MOST`` classes, its halves are
cut into narrower ones and go through 1 and 2 again, down to single windows,
where counting alone decides; so no task has to hold such a group.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import compact, mix, saved, scratch, ship, signed, steps, text_bytes
from vitalmart.llm.shingles import powers, prefix_hashes

LENGTH = 200
GRAM = 24
#: Classes of one first part that one task sorts.
MOST = 20_000
#: Strings of a run.
RUN = 20_000
#: Strings that one task merges at a time, about; it holds them all.
PER_TARGET = 100_000


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(document, anchor, first window, last window) of every run of windows
    within a document that have the same smallest gram (leftmost on ties);
    places in ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    w = length - gram + 1  # grams in a window
    if n < length:
        return none, none, none, none
    p = prefix_hashes(data)
    _, back = powers(n + 1)
    with np.errstate(over="ignore"):
        h = mix((p[gram:] - p[:-gram]) * back[:n - gram + 1])
    # hash above, place below: the smallest is the leftmost of the smallest hashes
    key = (h & ~np.uint64((1 << 32) - 1)) | np.arange(len(h), dtype=np.uint64)
    pad = -len(key) % w
    grid = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(tail[:windows], head[w - 1:w - 1 + windows]) & np.uint64((1 << 32) - 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    inside = np.arange(windows) + length <= offsets[1:][doc]
    s = np.flatnonzero(inside)
    a, d = least[s].astype(np.int64), doc[s]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])]) if len(s) else none
    last = np.r_[new[1:], len(s)] - 1 if len(s) else none
    return d[new], a[new], s[new], s[last]


def _halves(d, a, first, last, length, gram):
    """Cut runs into halves: (document, anchor, backward, low, high). Forward:
    main string text[a:], side string the bytes before a, windows by their
    bytes on the side, 0 to length // 2. Backward: main string the bytes
    before a + gram, side string text[a + gram:]."""
    half = length // 2
    near, far = a - last, a - first  # bytes before the anchor
    fore, aft = near <= half, far > half
    out = [(d[fore], a[fore], np.zeros(fore.sum(), np.int64), near[fore], np.minimum(far[fore], half)),
           # a window with b bytes before the anchor has length - b - gram on the side
           (d[aft], a[aft], np.ones(aft.sum(), np.int64), length - gram - far[aft],
            length - gram - np.maximum(near[aft], half + 1))]
    return tuple(np.concatenate(x) for x in zip(*out))


def _hashes(data, start, end, d, a, backward, grid_low, grid_high, length, gram):
    """Hash of the first part and of the whole reach of halves, for windows
    with grid_low to grid_high bytes on the side; cut at the document's ends.
    start, end: of each half's document."""
    p = prefix_hashes(data)
    _, back = powers(len(data) + 1)

    def span(s, e):
        s, e = np.maximum(s, start), np.minimum(e, end)
        return mix((p[e] - p[s]) * back[s] + (e - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                   + (a - s).astype(np.uint64))

    main = a + gram * backward  # where main and side string meet
    # forward: [main - side, main + m); backward: [main - m, main + side)
    f = backward == 0
    with np.errstate(over="ignore"):
        part = span(np.where(f, main - grid_low, main - (length - grid_high)),
                    np.where(f, main + (length - grid_high), main + grid_low))
        whole = span(np.where(f, main - grid_high, main - (length - grid_low)),
                     np.where(f, main + (length - grid_low), main + grid_high))
        salt = backward.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        return mix(part + salt), mix(whole + salt)


def _grid(backward, low, length, gram, width):
    """The fixed block of side bytes that ``low`` lies in."""
    top = np.where(backward == 0, length // 2, length - gram - length // 2 - 1)
    first = low // width * width
    return first, np.minimum(first + width - 1, top)


def _split(columns, length, gram, width):
    """Halves cut at the borders of blocks of ``width`` side bytes."""
    d, a, backward, low, high = columns
    times = high // width - low // width + 1
    at = np.repeat(np.arange(len(d)), times)
    k = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    block = low[at] // width + k
    return d[at], a[at], backward[at], np.maximum(low[at], block * width), np.minimum(high[at], block * width + width - 1)


_ITEM = "doc_id bigint, text_hash bigint, part bigint, whole bigint, a int, shape int"


def _pack(backward, low, high):
    return (backward | low << 1 | high << 12).astype(np.int32)


def _unpack(shape):
    shape = np.asarray(shape, np.int64)
    return shape & 1, shape >> 1 & 0x7FF, shape >> 12 & 0x7FF


def _items(length: int, gram: int, width: int):
    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            for i, j in steps(off):
                part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
                d, a, backward, low, high = _split(_halves(*anchors(part, at, length, gram), length, gram),
                                                   length, gram, width)
                first, whole = _hashes(part, at[d], at[d + 1], d, a, backward,
                                       *_grid(backward, low, length, gram, width), length, gram)
                take = pa.array(d + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(signed(first)),
                     pa.array(signed(whole)), pa.array((a - at[d]).astype(np.int32)), pa.array(_pack(backward, low, high))],
                    ["doc_id", "text_hash", "part", "whole", "a", "shape"])

    return run


def _narrowed(length: int, gram: int, width: int):
    """Halves of one document (its text and lists of a and shape) again, in
    narrower blocks."""

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            for i in range(batch.num_rows):
                part = data[off[i]:off[i + 1]]
                a = np.asarray(batch.column(3)[i].values, np.int64)
                columns = _split((np.zeros(len(a), np.int64), a, *_unpack(batch.column(4)[i].values)), length, gram, width)
                d, a, backward, low, high = columns
                first, whole = _hashes(part, d, d + len(part), d, a, backward,
                                       *_grid(backward, low, length, gram, width), length, gram)
                take = pa.array(d + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(signed(first)),
                     pa.array(signed(whole)), pa.array(a.astype(np.int32)), pa.array(_pack(backward, low, high))],
                    ["doc_id", "text_hash", "part", "whole", "a", "shape"])

    return run


# --- sorted runs -----------------------------------------------------------


def common(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(x), len(y))
    if x[known:n] == y[known:n]:
        return n
    a = known  # equal up to a, not up to n
    while n - a > 1:
        m = (a + n) // 2
        if x[a:m] == y[a:m]:
            a = m
        else:
            n = m
    return a


def merged(runs: list[tuple[list[bytes], list[int]]]):
    """Merge sorted runs, each with its strings' common prefix with the one
    before, by a loser tree: yields (run, place in it, common prefix with the
    last string put out). A string is never compared below what is known to be
    common with that last string."""
    k = len(runs)
    if k == 1:
        yield from ((0, i, h) for i, h in enumerate(runs[0][1]))
        return
    size = 1 << (k - 1).bit_length()
    place = [0] * size
    known = [0] * size  # common prefix with the last string put out
    done = [r >= k or not runs[r][0] for r in range(size)]

    def play(x, y):
        """(winner, loser); the loser's known prefix becomes the one it has
        with the winner."""
        if done[x] or done[y]:
            return (y, x) if done[x] else (x, y)
        hx, hy = known[x], known[y]
        if hx != hy:  # the longer one is closer to the last string
            return (x, y) if hx > hy else (y, x)
        s, t = runs[x][0][place[x]], runs[y][0][place[y]]
        h = common(s, t, hx)
        first = x if h == len(s) and (h < len(t) or x < y) or h < len(s) and h < len(t) and s[h] < t[h] else y
        other = y if first == x else x
        known[other] = h
        return first, other

    losers = [0] * size
    level = list(range(size))
    start = size // 2
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            w, lo = play(level[i], level[i + 1])
            losers[start + i // 2] = lo
            up.append(w)
        level = up
        start //= 2
    top = level[0]
    while not done[top]:
        yield top, place[top], known[top]
        place[top] += 1
        if place[top] == len(runs[top][0]):
            done[top] = True
        else:
            known[top] = runs[top][1][place[top]]
        node = (size + top) // 2
        while node:
            w, lo = play(top, losers[node])
            losers[node] = lo
            top = w
            node //= 2


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Common prefix with the string before, length of the rest, the rests."""
    shared, rest, last = [], [], b""
    for s in strings:
        h = common(s, last)
        shared.append(h)
        rest.append(s[h:])
        last = s
    return np.array(shared, np.int16), np.array([len(r) for r in rest], np.int16), b"".join(rest)


def decoded(shared, lengths, rest: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for h, n in zip(shared.tolist(), lengths.tolist()):
        last = last[:h] + rest[at:at + n]
        at += n
        out.append(last)
    return out


def repeats(group: list[int], lcp: list[int], sides: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """Windows that repeat within a group of main strings, given in order with
    their common prefixes (lcp[i]: of i - 1 and i): (member, low, high) in
    bytes on the side. A node of depth h of the tree of common prefixes lets
    a pair repeat at length - h to (common prefix of the sides) bytes."""
    out = []

    def closed(depth, children):
        runs = [([sides[i] for i in c], h) for c, h in children]
        order, shared = [], []
        for r, i, h in merged(runs):
            order.append(children[r][0][i])
            shared.append(h)
        need = max(0, length - depth)
        for k, i in enumerate(order):
            most = max(shared[k] if k else -1, shared[k + 1] if k + 1 < len(order) else -1)
            if most >= need:
                out.append((i, need, most))
        return order, shared

    # nodes still open, from the root: [depth, children]
    stack: list[list] = []
    current = ([group[0]], [0])
    for k in range(1, len(group)):
        depth = lcp[k]
        while stack and stack[-1][0] > depth:
            node = stack.pop()
            node[1].append(current)
            current = closed(*node)
        if not stack or stack[-1][0] < depth:
            stack.append([depth, []])
        stack[-1][1].append(current)
        current = ([group[k]], [0])
    while stack:
        node = stack.pop()
        node[1].append(current)
        current = closed(*node)
    return out


_RUN = ("target int, parts binary, shared binary, lengths binary, rest binary, sides binary, side_lengths binary, "
        "refs binary")


def _runs(length: int, gram: int, targets: int):
    """Main and side strings of halves, as sorted front-coded runs by target
    (all strings of one first part have one target)."""

    def emit(held):
        press = zstandard.ZstdCompressor(level=1)
        for target, rows in held.items():
            rows.sort(key=lambda r: r[0])
            shared, lengths, rest = front_coded([r[0] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([target], pa.int32()), *[pa.array([press.compress(x)], pa.binary()) for x in (
                    np.array([r[2] for r in rows], np.int64).tobytes(), shared.tobytes(), lengths.tobytes(), rest,
                    b"".join(r[1] for r in rows), np.array([len(r[1]) for r in rows], np.int16).tobytes(),
                    np.array([r[3:] for r in rows], np.int64).tobytes())]],
                ["target", "parts", "shared", "lengths", "rest", "sides", "side_lengths", "refs"])

    def run(batches):
        held: dict[int, list] = {}
        count = 0
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            raw = data.tobytes()
            docs, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                s0, e0 = int(off[i]), int(off[i + 1])
                a, shape, part, single = (np.asarray(batch.column(k)[i].values, np.int64) for k in (3, 4, 5, 6))
                for x, b, lo, hi, p, one, sh in zip(a.tolist(), *(v.tolist() for v in _unpack(shape)), part.tolist(),
                                                    single.tolist(), shape.tolist()):
                    at = s0 + x
                    if b:
                        at += gram
                        main, side = raw[max(s0, at - length):at][::-1], raw[at:min(e0, at + length // 2)]
                    else:
                        main, side = raw[at:min(e0, at + length)], raw[max(s0, at - length // 2):at][::-1]
                    held.setdefault(p % targets, []).append(
                        (main, side, p, docs[i], hashes[i], x, sh, one))
                    count += 1
                if count >= RUN:
                    yield from emit(held)
                    held, count = {}, 0
        yield from emit(held)

    return run


def _sorted(length: int, gram: int):
    """Merge the runs of each target; spans of the windows that repeat, for
    halves that are not settled yet."""

    def solve(runs):
        unpress = zstandard.ZstdDecompressor()
        strings, meta = [], []
        for r in runs:
            parts, shared, lengths, rest, sides, side_lengths, refs = (unpress.decompress(x) for x in r)
            shared, lengths = np.frombuffer(shared, np.int16), np.frombuffer(lengths, np.int16)
            ends = np.cumsum(np.frombuffer(side_lengths, np.int16).astype(np.int64)).tolist()
            strings.append((decoded(shared, lengths, rest), shared.tolist()))
            meta.append((np.frombuffer(parts, np.int64).tolist(),
                         [sides[a:b] for a, b in zip([0, *ends], ends)], np.frombuffer(refs, np.int64).reshape(-1, 5)))
        parts, sides, refs, lcps = [], [], [], []
        for r, i, h in merged(strings):
            parts.append(meta[r][0][i]), sides.append(meta[r][1][i]), refs.append(meta[r][2][i]), lcps.append(h)
        found = []
        # strings of one first part need not lie side by side (those read
        # forward and backward are in one order), so each part takes its own
        members: dict[int, list[int]] = {}
        for k, p in enumerate(parts):
            members.setdefault(p, []).append(k)
        position = {}
        for p, group in members.items():
            if len(group) > 1 and any(refs[k][4] for k in group):
                position[p] = group
        if position:
            for p, group in position.items():
                lcp = [0] + [min(lcps[x + 1:y + 1]) for x, y in zip(group, group[1:])]
                for i, low, high in repeats(group, lcp, sides, length):
                    if refs[i][4]:
                        found.append((refs[i], low, high))
        return found

    def spans(found):
        docs, hashes, starts, ends = [], [], [], []
        for (doc, text_hash, a, shape, _), need, most in found:
            b, low, high = (int(v) for v in _unpack(shape))
            low, high = max(low, need), min(high, most)
            if low > high:
                continue
            docs.append(int(doc)), hashes.append(int(text_hash))
            if b:  # side bytes behind a + gram
                starts.append(int(a) + gram + low - length), ends.append(int(a) + gram + high)
            else:
                starts.append(int(a) - high), ends.append(int(a) - low + length)
        return pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(hashes, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            ["doc_id", "text_hash", "start", "end"])

    def run(batches):
        target, runs = None, []
        for batch in batches:
            for t, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if t != target and runs:
                    yield spans(solve(runs))
                    runs = []
                target = t
                runs.append(rest)
        if runs:
            yield spans(solve(runs))

    return run


def _finished(batches):
    """Removed runs and what is kept of each text."""
    for batch in batches:
        data, off = text_bytes(batch.column(1))
        out = [[] for _ in range(6)]
        for i in range(batch.num_rows):
            text = data[off[i]:off[i + 1]].tobytes()
            starts, ends = [], []
            if batch.column(2)[i].is_valid:
                s, e = (np.asarray(batch.column(k)[i].values, np.int64) for k in (2, 3))
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order])
                new = np.flatnonzero(np.r_[True, s[1:] > e[:-1]])
                starts, ends = s[new].tolist(), e[np.r_[new[1:] - 1, len(e) - 1]].tolist()
            kept = b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)]))
            for o, v in zip(out, (len(text), len(text) - len(kept), len(starts), sha256(kept).hexdigest(), starts, ends)):
                o.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(o, pa.int64()) for o in out[:3]], pa.array(out[3], pa.string()),
             *[pa.array(o, pa.list_(pa.int32())) for o in out[4:]]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST,
                    per_target: int = PER_TARGET) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, starts, ends (of the removed runs, in UTF-8 bytes).

    Removed is every byte of a string of ``length`` bytes that starts anywhere
    else too, in any row, judged on the input. Null text is empty; a text
    below ``length`` bytes loses nothing; repeated rows count as copies; null
    doc_ids are ids like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    # a document's key has no null: the hash tells a null doc_id from 0
    own = F.col("doc_id").cast("bigint")
    rows = docs.select(own.alias("given"), F.coalesce(own, F.lit(0)).alias("doc_id"),
                       F.xxhash64("text", own.isNull()).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    long = rows.where(F.octet_length("text") >= length).drop("given")
    key = ["doc_id", "text_hash"]
    least = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    spans: list[DataFrame] = []
    with scratch(spark) as path:
        # all side bytes of a half in one block at first, then narrower ones
        items, width = long.mapInArrow(_items(length, gram, 2 * length), _ITEM), 2 * length
        while True:
            # written, so that the join is between two plain shuffles, which Spark can split
            shared = saved(items.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("part"))
            hits = compact(items.join(shared, "part"), f"{path}/hits{width}")
            classes = compact(hits.groupBy("part", "whole").agg(
                F.count(F.lit(1)).alias("n"), F.min(F.struct(*key, "a", "shape")).alias("r")), f"{path}/classes{width}")
            alike = classes.where("n > 1").select("part", "whole")
            spans.append(hits.join(alike, ["part", "whole"]).select(*key, "a", "shape"))
            open_ = (classes.groupBy("part").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"))
                     .where("k > 1 AND least = 1").select("part", "k"))
            going = compact(classes.join(open_, "part").select(
                "r.*", "part", (F.col("n") == 1).cast("int").alias("single"), "k"), f"{path}/going{width}")
            per_doc = [F.collect_list(c).alias(c) for c in ("a", "shape", "part", "single")]
            few = going.where(F.col("k") <= most).groupBy(*key).agg(*per_doc)
            # as many targets as keep the strings of one within a task, however large the corpus
            targets = max(least, -(-going.where(F.col("k") <= most).count() // per_target))
            # a half's document may be there in several rows: any of them will do
            runs = (few.join(long, key).dropDuplicates(key)
                    .select(*key, "text", "a", "shape", "part", "single")
                    .mapInArrow(_runs(length, gram, targets), _RUN))
            found = (runs.repartition(targets, "target").sortWithinPartitions("target")
                     .mapInArrow(_sorted(length, gram), "doc_id bigint, text_hash bigint, start int, end int"))
            spans.append(compact(found, f"{path}/found{width}"))
            many = going.where(F.col("k") > most)
            if width == 1 or many.isEmpty():
                break
            width = max(1, min(length // 2, width) // 10)
            # single halves with their classes' halves: those of many classes, all occurrences
            again = hits.join(many.select("part").distinct(), "part").groupBy(*key).agg(
                F.collect_set(F.struct("a", "shape")).alias("s"))
            items = (again.join(long, key).select(*key, "text", F.col("s.a").alias("a"), F.col("s.shape").alias("shape"))
                     .mapInArrow(_narrowed(length, gram, width), _ITEM))
        shape = F.col("shape")
        low, high = F.shiftright(shape, 1).bitwiseAND(0x7FF), F.shiftright(shape, 12).bitwiseAND(0x7FF)
        back = shape.bitwiseAND(1) == 1
        whole = [s.select(*key, F.when(back, F.col("a") + gram + low - length).otherwise(F.col("a") - high).alias("start"),
                          F.when(back, F.col("a") + gram + high).otherwise(F.col("a") - low + length).alias("end"))
                 for s in spans[0::2]]
        cut = whole[0]
        for s in [*whole[1:], *spans[1::2]]:
            cut = cut.unionByName(s)
        by_doc = (cut.groupBy(*key).agg(F.collect_list(F.struct("start", "end")).alias("s"))
                  .select(*key, F.col("s.start").alias("starts"), F.col("s.end").alias("ends")))
        return saved(rows.join(by_doc, key, "left").select("given", "text", "starts", "ends").mapInArrow(
            _finished, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                       "starts array<int>, ends array<int>"))
