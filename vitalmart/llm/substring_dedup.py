"""Substring dedup by hashing lines and their sentences.

Units are the lines of a text and, within lines of several sentences, the
sentences, so that a passage set into running text is met as well. A unit is
normalised (lowered, words only, with their combining marks) and hashed to
128 bits; over the whole corpus the earliest occurrence of each digest, by
document and place, stays, all others go. Units of fewer than ``least_words``
words that have fewer than ``LEAST_LETTERS`` letters as well always stay:
common short phrases repeat by chance. (Scripts without spaces have few words
in any length of text.)
"""

from __future__ import annotations

import re
import unicodedata
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import saved, ship

#: Word characters (letters, digits) from which on a unit of few words is one.
LEAST_LETTERS = 20
#: Vowel signs and other combining marks, which \w leaves out.
_MARKS = "".join(c for c in map(chr, [*range(0x300, 0x20000), *range(0xE0100, 0xE01F0)]) if unicodedata.category(c)[0] == "M")
_PLAIN, _MARKED = re.compile(r"\w+"), re.compile(rf"\w+(?:(?![\x00-\u02ff])[{_MARKS}]+\w*)*")
_NO_MARKS = dict.fromkeys(map(ord, _MARKS))
_LINE = re.compile(r"[^\n]*\n|[^\n]+")
# full-width marks need no blank after them, but take closing quotes and brackets along
_SENTENCE = re.compile(r".(?:[^.!?।॥۔؟。！？｡]+|.)*?(?:[.!?।॥۔؟]+(?=\s)\s*|[。！？｡]+[」』”’）】》]*\s*|\Z)", re.S)


def _words(text: str) -> list[str]:
    return (_PLAIN if text.isascii() else _MARKED).findall(text.lower())


def _long(words: list[str], least_words: int) -> bool:
    if len(words) >= least_words:
        return True
    letters = "".join(words)
    return len(letters) >= LEAST_LETTERS and len(letters.translate(_NO_MARKS)) >= LEAST_LETTERS


def units(text: str, least_words: int):
    """(start, end, digest) of every unit, in code points, the blanks after it
    included."""
    for line in _LINE.finditer(text):
        whole = line[0]
        words = _words(whole)
        if not _long(words, least_words):
            continue
        yield line.start(), line.end(), _digest(words)
        parts = [m.span() for m in _SENTENCE.finditer(whole)]
        if len(parts) > 1:
            for a, b in parts:
                own = _words(whole[a:b])
                if _long(own, least_words):
                    yield line.start() + a, line.start() + b, _digest(own)


def _digest(words: list[str]) -> bytes:
    return blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _listed(least_words: int):
    def run(batches):
        for batch in (b.slice(a, 1000) for b in batches for a in range(0, b.num_rows, 1000)):
            row, start, end, digest = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for a, b, d in units(text or "", least_words):
                    row.append(i), start.append(a), end.append(b), digest.append(d)
                if len(row) > 50_000:
                    yield out(batch, row, start, end, digest)
                    row, start, end, digest = [], [], [], []
            yield out(batch, row, start, end, digest)

    def out(batch, row, start, end, digest):
        halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        at = pa.array(row, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
             pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))],
            ["doc_id", "text_hash", "start", "end", "d1", "d2"])

    return run


def repeated(docs: DataFrame, least_words: int = 5) -> DataFrame:
    """Spans to remove: doc_id, text_hash (xxhash64 of the text), starts, ends
    (sorted, in code points; spans may lie within others); documents without
    any are left out."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").where("text <> ''")
    found = rows.mapInArrow(_listed(least_words), "doc_id bigint, text_hash bigint, start int, end int, d1 bigint, d2 bigint")
    place = F.struct("doc_id", "text_hash", "start")
    # counted before the shuffle, so a line of a third of all documents is one row per task
    # (and written, so that the join below is between two plain shuffles, which Spark can split)
    earliest = saved(found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").drop("n"))
    later = found.join(earliest, ["d1", "d2"]).where(~place.eqNullSafe(F.col("first")))
    return (later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("s"))
            .select("doc_id", "text_hash", F.col("s.start").alias("starts"), F.col("s.end").alias("ends")))


def _kept(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    def cut(t, a, b):
        if t is None or a is None:
            return t
        out, at = [], 0
        for s, e in zip(a, b):
            if s > at:
                out.append(t[at:s])
            at = max(at, e)
        out.append(t[at:])
        return "".join(out)

    return pd.Series([cut(*x) for x in zip(text, starts, ends)], dtype=object)


def without_repeats(docs: DataFrame, least_words: int = 5) -> DataFrame:
    """All columns of ``docs``, with kept_text, and starts and ends of what was
    removed from the original text (empty lists: nothing).

    Of equal units the one of the smallest (doc_id, text hash, place) stays;
    rows alike in doc_id and text count as one document and lose the same.
    Null doc_ids rank first; null and empty texts have no units and stay as
    they are; an empty table gives no rows. A column of ``docs`` that has the
    name of one of the three is replaced.
    """
    names = docs.columns
    spans = repeated(docs, least_words)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("bigint").alias("its_id"),
                      F.xxhash64("text").alias("its_hash"))
    joined = own.join(spans, F.col("its_id").eqNullSafe(F.col("doc_id")) & (F.col("its_hash") == F.col("text_hash")), "left")
    none = F.array().cast("array<int>")
    new = {"kept_text": F.pandas_udf(_kept, "string")(F.col("row")["text"], "starts", "ends"),
           "starts": F.coalesce("starts", none), "ends": F.coalesce("ends", none)}
    return joined.select(*[F.col("row")[c].alias(c) for c in names if c not in new], *[v.alias(c) for c, v in new.items()])
