"""Inputs that once gave wrong results or stopped a job: words whose hashes
cancelled out, ids with several texts, columns with the operators' own names,
vast components, many sources and languages."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitalmart.llm import common, exact_topk, language_id, minmax_dedup, mixing, substring_dedup, tokens
from vitalmart.llm.queries import tokenizer_path


def morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 256, 1024, 4096])
def test_words_that_cancel_out(n):
    from tokenizers import Tokenizer

    own, plain = morse(n), Tokenizer.from_file(tokenizer_path())
    raw = [w.encode() for w in own]
    ids, k = tokens.Encoder(tokenizer_path()).encode(np.frombuffer(b"".join(raw), np.uint8), np.array([0, n, 2 * n]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(k)[:-1])] == [plain.encode(w, add_special_tokens=False).ids for w in own]


def test_documents_of_words_that_cancel_out(spark):
    made = [(i, w) for i, w in enumerate([*morse(1024), *morse(4096)])]
    got = minmax_dedup.near_duplicates(spark.createDataFrame(made, "doc_id bigint, text string"), shingle=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i) for i in range(4)]


def test_word_hashes_are_the_words_own():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abc"), k)) for k in [*range(1, 40), *range(1, 40), 255, 256, 257, 300, 300]]
    raw = " ".join([*words, *words]).encode()
    from vitalmart.llm.shingles import word_hashes

    h, _ = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert (h[:len(words)] == h[len(words):]).all() and len(set(h.tolist())) == len(set(words))


def test_texts_under_one_id_are_not_lost(spark):
    x, y = "one text of quite a few words in all", "and another text that shares nothing with it"
    made = [(1, x), (1, y), (5, y), (7, x + " and much more"), (None, y), (None, None), (9, x), (9, x)]
    got = minmax_dedup.one_of_each(spark.createDataFrame(made, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(0, ""), (1, x), (1, y), (7, x + " and much more")])


CLASHES = ["score", "lang_pred", "starts", "ends", "_id", "_hash", "_times", "_text_hash", "_source", "text_hash", "_copy", "kept_text",
           "row", "number", "times", "its_id", "part"]


def clashing(spark, made):
    docs = spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for k, c in enumerate(CLASHES):
        docs = docs.withColumn(c, F.concat(F.lit(f"{k}:"), F.col("doc_id").cast("string")))
    return docs.withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id")))


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    rng = np.random.default_rng(3)
    made = [(i, " ".join("".join(rng.choice(list("abcde"), 5)) for _ in range(40)) + ".\nA line that they all have in common here.\n",
             "en", f"s{i % 3}", 1) for i in range(30)] + [(30, None, "en", None, 0), (None, "no id in here", "fr", "s1", 1)]
    docs = clashing(spark, made)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        rows = got.collect()
        assert len(rows) >= 20
        for r in rows:
            assert all(r[c] == (f"{k}:{r.doc_id}" if r.doc_id is not None else None) for k, c in enumerate(CLASHES)), name
            assert r.tags == {"a": r.doc_id}
        docs = got
    assert docs.where(F.col("text").contains("in common")).select("doc_id").distinct().count() <= 1


def test_operators_with_clashing_columns(spark):
    docs = clashing(spark, [(1, "some words that are here twice", "en", "s", 1), (2, "some words that are here twice", "en", "s", 1)])
    assert language_id.known(docs).columns == docs.columns
    assert mixing.sampled(docs).columns == docs.columns
    got = substring_dedup.without_repeats(docs).orderBy("doc_id").collect()
    assert [(r.kept_text, r._id, r._text_hash) for r in got] == [("some words that are here twice", "4:1", "7:1"), ("", "4:2", "7:2")]


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_of_little(spark, tmp_path, empty):
    made = [] if empty else [(None, "first text without an id", "en", "s", 1), (None, "second one, of other words", "en", None, 2)]
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (len(got) == 0) == empty


def test_finite_vectors_of_any_size(spark):
    made = [(0, [2.0 ** 54, 1.0]), (50, [1.0, 2.0]), (3, [2.0 ** 54, 2.0]), (4, [float("inf"), 1.0]), (5, [float("nan"), 1.0]), (6, None)]
    got = exact_topk.nearest(spark.createDataFrame(made, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    top = {}
    own = {i: [int(np.floor(256 * c)) for c in v] for i, v in made if i < 4 or i == 50}
    for q in (0, 50):
        best = sorted((-min(sum(a * b for a, b in zip(own[q], v)), (1 << 63) - 1), i) for i, v in own.items() if i != q)
        top[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert {q: sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) for q in (0, 50)} == top


def test_top_k_reads_few_exact_vectors(spark):
    """Cells alone leave a small part of the vectors, over all blocks, and
    among them every one of the k best; hot copies of a vector are all kept."""
    rng = np.random.default_rng(11)
    x = rng.normal(0, 0.2, (6000, 32))
    x[1000:3000] = x[999]  # a third of all rows alike
    made = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(made, "vec_id bigint, embedding array<double>").repartition(4)
    got = exact_topk.nearest(frame, F.col("vec_id") % 50 == 0, block=700).collect()
    whole = np.floor(256 * x).astype(np.int64)
    want = []
    for q in range(0, 6000, 50):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(6000), -score)) if i != q][:5]
        want += [(q, r + 1, int(i), int(score[i])) for r, i in enumerate(order)]
    assert sorted(map(tuple, got)) == want
    with common.scratch(spark) as path:
        rows = exact_topk._usable(frame, 256)
        blocks = exact_topk.indexed(exact_topk.candidates(rows, 5), path, 700)
        n = exact_topk.survivors(blocks, exact_topk.questions(rows.where("vec_id % 50 = 0"), path), path, 5).count()
    assert 120 * 5 <= n < 120 * 6000 // 100  # below one in a hundred


def test_top_k_of_repeated_rows(spark):
    """Rows repeated as a whole, more often than k: as queries once, as
    candidates all; never the query's own id."""
    made = [(0, [1.0, 0.5])] * 9 + [(i, [1.0, 0.5]) for i in range(40, 61)] + [(7, [0.5, 0.5])] * 8 + [(50, [0.25, 0.0])]
    got = exact_topk.nearest(spark.createDataFrame(made, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    whole = [(i, [int(256 * c) for c in v]) for i, v in made]
    want = []
    for q in (0, 50):
        own = min(v for i, v in whole if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == want


def test_long_chains_settle(spark):
    edges = [(i, i + 1) for i in range(3000)]
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert got.count() == 3001 and {r.component for r in got.collect()} == {0}


def test_many_languages_against_plain_naive_bayes(spark):
    """Counts of whole n-grams in plain dictionaries; hashing may only add to
    them, which these few n-grams don't let happen."""
    rng = np.random.default_rng(6)
    letters = {f"l{k:03}": "abcdefgh"[k % 8] + "ijklmnop"[k // 8 % 8] + "qrstu"[k // 64] for k in range(300)}
    names = list(letters)
    made = [(i, "".join(rng.choice(list(letters[names[i % 300]]) + ["z", " "], 12)), names[i % 300]) for i in range(1500)]
    got = {r.doc_id: r for r in language_id.languages(spark.createDataFrame(made, "doc_id bigint, text string, lang string")).collect()}

    def grams(t):
        t = f" {t.lower()} "
        return [t[k:k + n] for n in (1, 2, 3) for k in range(len(t) - n + 1)]

    counts, docs = defaultdict(Counter), Counter()
    for i, t, lang in made:
        if zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(grams(t))
            docs[lang] += 1
    total = {lang: sum(c.values()) + 0.5 * language_id.BUCKETS for lang, c in counts.items()}
    agree = 0
    for i, t, _ in made[:150]:
        if not any(c.isalpha() for c in t):
            assert got[i].lang_pred == "und"
            continue
        logs = {lang: math.log(docs[lang] / docs.total()) + sum(math.log((c[g] + 0.5) / total[lang]) for g in grams(t))
                for lang, c in counts.items()}
        best = max(logs.values())
        score = 1 / sum(math.exp(v - best) for v in logs.values())
        agree += abs(got[i].score - score) < 1e-6 and abs(logs[got[i].lang_pred] - best) < 1e-9
    assert len(docs) > 256 and agree >= 145  # n-grams that share a bucket shift a score here and there
