"""Language identification: multinomial naive Bayes over hashed character
n-grams of the lowered text."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import ship

BUCKETS = 1 << 16
SIZES = (1, 2, 3)
_LETTER = re.compile(r"[^\W\d_]")
_STEP_CHARS = 1 << 20


def _steps(texts: list[str]):
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 2
        if size >= _STEP_CHARS:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram size the bucket at every code point of all texts (each
    set between spaces), and where each text begins, and the end. A start too
    close to its text's end for the size has bucket BUCKETS."""
    padded = [f" {t.lower()} " for t in texts]
    begin = np.cumsum([0, *map(len, padded)])
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for size in SIZES:
            h = np.full(len(points), size, np.uint64)
            for k in range(size):
                h *= np.uint64(0x9E3779B97F4A7C15)
                h[:len(points) - k] += points[k:]
            h ^= h >> np.uint64(29)
            b = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int32)
            for k in range(1, size):
                b[begin[1:] - k] = BUCKETS
            out.append(b)
    return out, begin


def _slices(batches, rows: int = 1000):
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _counted(batches):
    """Per task: the n-gram counts and documents of each language."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def emit():
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.r_[-1, at].astype(np.int32)),
                 pa.array(np.r_[docs[lang], c[at]].astype(np.int64))], ["lang", "bucket", "n"])
        counts.clear(), docs.clear()

    for batch in _slices(batches):
        texts, langs = np.array(batch.column(0).to_pylist(), object), np.array(batch.column(1).to_pylist(), object)
        for lang in dict.fromkeys(langs):
            own = texts[langs == lang].tolist()
            for a, b in _steps(own):
                total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for g in grams(own[a:b])[0]:
                    total += np.bincount(g, minlength=BUCKETS + 1)[:BUCKETS]
            docs[lang] = docs.get(lang, 0) + len(own)
            if len(counts) > 64:
                yield from emit()
    yield from emit()


def fit(labelled: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, their log priors, and the log probabilities
    (buckets + 1, languages; the last row is zero) out of all rows of
    ``labelled`` (text, lang) where neither is null."""
    ship(labelled.sparkSession)
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    summed = (rows.mapInArrow(_counted, "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # the model: a row per language of at most BUCKETS + 1 counts, 512 KB each
    # once broadcast; it grows with the languages named, not with the rows
    found = (summed.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
             .orderBy("lang").toArrow())
    langs = found.column("lang").to_pylist()
    counts, docs = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for i in range(len(langs)):
        b, n = (np.array(found.column(c)[i].values) for c in ("b", "n"))
        counts[b[b >= 0], i], docs[i] = n[b >= 0], n[b < 0].sum()
    logs = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * BUCKETS))
    return langs, np.log(docs / max(docs.sum(), 1)), np.vstack([logs, np.zeros((1, len(langs)))])


def _scored(model, text: int, keep: int):
    """text: the column of the text; keep: the columns to hand on."""

    def run(batches):
        langs, prior, logs = model.value
        tables = [np.ascontiguousarray(logs[:, i]) for i in range(len(langs))]
        for batch in _slices(batches):
            texts = batch.column(text).to_pylist()
            scored = [i for i, t in enumerate(texts) if t and langs and _LETTER.search(t)]
            names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            own = [texts[i] for i in scored]
            for a, b in _steps(own):
                gs, begin = grams(own[a:b])
                total = np.empty((b - a, len(langs)))
                for k, t in enumerate(tables):
                    total[:, k] = prior[k] + sum(np.add.reduceat(t[g], begin[:-1]) for g in gs)
                best = total.argmax(axis=1)
                at = scored[a:b]
                names[at] = np.array(langs, object)[best]
                score[at] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array(names, pa.string()), pa.array(score)],
                [*batch.schema.names[:keep], "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score (the
    posterior of the language, 0 to 1). ``und`` and 0: the text is null or has
    no letter, or nothing was learned. Reads whole texts only."""
    spark = docs.sparkSession
    ship(spark)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    cols = keep if "text" in keep else [*keep, "text"]
    return docs.select(*cols).mapInArrow(
        _scored(spark.sparkContext.broadcast(model), cols.index("text"), len(keep)), schema)


def held_out(doc_id: str = "doc_id"):
    """A fifth of the documents, by their id; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, learned from the rows of
    ``docs`` that aren't held out and have text and lang. Repeated rows are
    learned and returned as often as they are there; an empty table gives no
    rows; without any label all are ``und``."""
    model = fit(docs.where(~held_out()))
    own = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(own, model, ["doc_id", "held_out"])


def _lettered(text: pd.Series) -> pd.Series:
    return pd.Series([bool(t and _LETTER.search(t)) for t in text], dtype=bool)


def known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without those rejected: no letters, or no language with a
    posterior of ``least``. Where no language can be learned (no row that isn't
    held out has text and lang) only those without letters go. All columns stay
    as they are, whatever their names; repeated rows stay or go alike; an empty
    table gives no rows."""
    model = fit(docs.where(~held_out()))
    if not model[0]:
        return docs.where(F.pandas_udf(_lettered, "boolean")("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    judged = predict(rows, model, ["row"])
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("row.*")
