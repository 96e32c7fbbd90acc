"""Content sort, spelling trie and block whitening on small tables with nulls,
empty and long values, ties, repeated rows and clashing columns, against plain
versions; and on empty ones."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from vitalmart.llm import block_whitening, content_sort, spelling_trie

DOCS = "doc_id bigint, text string, word string, n bigint, pid int, run string, body string, row string, kept map<string,int>"


def table(spark, made, parts=5):
    return spark.createDataFrame([(i, t, "w", 1, 2, "r", "b", "x", {"a": 1}) for i, t in made], DOCS).repartition(parts)


# --- content sort ---------------------------------------------------------

def texts():
    rng = np.random.default_rng(4)
    long = " ".join("".join(rng.choice(list("abé ß"), 9)) for _ in range(30_000))
    made = [(1, "a b c"), (2, "abc"), (3, "a  bc"), (4, "\ta b\x0bc\n"), (5, None), (6, ""), (7, " \r\n\x0c"), (8, "Abc"),
            (9, "a bc"), (10, long), (11, long.replace(" ", "")), (12, long + "x"), (13, "é"), (14, "é"), (None, "abc"),
            (None, "a b c d"), (None, None), (2, "abc"), (2, "abc"), (1, "other"), (1, "a b c")]
    made += [(100 + i, "the same text " + " " * (i % 3)) for i in range(400)]   # a large group
    made += [(600 + i, "x" * 40 + str(i % 150)) for i in range(300)]              # one beginning
    return made


def bare(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_copies(spark, partitions):
    made, before = texts(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = content_sort.exact_copies(table(spark, made)).collect()
        whole = content_sort.without_copies(table(spark, made))
        left = whole.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = defaultdict(list)
    for i, t in made:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i))
    want = Counter((i, min(groups[bare(t)])[3], len(groups[bare(t)]), sha256(bare(t).encode()).hexdigest()) for i, t in made)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(sha256(k.encode()).hexdigest() for k in groups)
    assert all(r.doc_id == r.keep_id for r in kept)
    assert whole.dtypes == table(spark, made[:1]).dtypes
    assert sorted((bare(r.text), -len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in left) == sorted(
        (k, *min(g)[:3]) for k, g in groups.items())


def test_no_copies_of_nothing(spark):
    assert content_sort.exact_copies(table(spark, [])).count() == 0
    assert content_sort.without_copies(table(spark, [])).count() == 0
    assert [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in content_sort.exact_copies(table(spark, [(None, None)])).collect()] == [
        (None, None, 1, True)]


# --- spelling trie --------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain_variants(made, spoilt=97):
    count = Counter()
    for i, t in made:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spoilt == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def spelled():
    rng = np.random.default_rng(7)
    base = ["".join(rng.choice(list("abcé"), rng.integers(4, 9))) for _ in range(150)]
    made = []
    for i in range(260):
        words = []
        for w in rng.choice(base, 40, p=np.arange(1, 151) / np.arange(1, 151).sum()):
            k = int(rng.integers(0, len(w)))
            words.append([w, w, w, w[:k] + w[k + 1:], w[:k] + "d" + w[k:], w[:k] + "À" + w[k + 1:], w.upper()][int(rng.integers(0, 7))])
        made.append((i, " ".join(words)))
    long = "".join(rng.choice(list("xyz"), 3000))
    made += [(900, f"{long} {long}; {long}! {long[1:]}-{long[1:]} {long[1:]}"), (901, f"{long[:-1]}q " * 8)]
    # nested words, ties, edits at either end, a chain of forms, many neighbours of one word
    made += [(902, " ".join("a" * k for k in range(3, 60))) for _ in range(3)]
    made += [(903, "kitten " * 4 + "mitten " * 4 + "bitten " * 8 + "kittens " * 4 + "itten " * 3 + "ekitten " * 3)]
    made += [(904, "chaina " * 3 + "chainb " * 3 + "chaibb " * 8 + "chabbb " * 17 + "chbbbb " * 40)]
    made += [(905, " ".join(f"{p}-{p}-{p}" for k in range(12) for p in ["hubword"[:k % 8] + c + "hubword"[k % 8:] for c in "abcdefghijklm"]) + " hubword" * 90)]
    made += [(906, None), (907, ""), (908, " 12 _! "), (None, "nullid nullid nullid"), (909, "ÀÉÎÕÜ×÷ " * 3 + "àéîõü " * 4 + "İıŁł")]
    return made + [made[0], made[0], made[3]]


def test_variants(spark):
    made = spelled()
    got = spelling_trie.variants(table(spark, made)).collect()
    want = plain_variants(made)
    assert len(got) == len(want)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert any(len(w) > 2000 and v[0] for w, v in want.items()) and want["chaibb"][1] == "chbbbb"
    assert want["kitten"][0] == "bitten" and want["hubword"][3] > 80


def test_states_are_compiled(spark, monkeypatch):
    """No lambda, which Spark interprets for each row, runs over the states
    joined with their edges; letters that share a bit (a and á) or lie beyond
    16 bits are told apart."""
    plans, compact = {}, spelling_trie.compact

    def noted(df, path, *codec):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().optimizedPlan().toString()
        return compact(df, path, *codec)

    monkeypatch.setattr(spelling_trie, "compact", noted)
    words = ["a", "á", "ab", "b", "abcda", "abcdá", "abcdaa", "abcdáx", "abáda", "áabcda", "bcda", "rivers", "ri\U0001f600ers",
             "ri\U0001f601ers", "ri\u6600ers", "riers", "riverside", "riverride", "rivverside", "iverside", "riversid"]
    got = spelling_trie.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a in words for b in words if one_edit(a, b))
    levels = [plan for name, plan in plans.items() if name.startswith("level")]
    assert len(levels) > 1 and not any("lambda" in plan for plan in levels)


@pytest.mark.parametrize("case", ["ſtill Kelvin", "wordſword", "naïve\u0301 naïve", "\U0001f600smile?smile"])
def test_runs_of_latin_letters(spark, case):
    """Code points beyond Latin-1 end a run and are never made letters."""
    made = [(i, f"{case} {case.upper()}") for i in range(3)]
    got = spelling_trie.counted_words(table(spark, made)).collect()
    assert {(r.word, r.n) for r in got} == {(w, v[2]) for w, v in plain_variants(made).items()}


@pytest.mark.parametrize("made", [[], [(1, None), (2, "")], [(1, "short four word word word")]])
def test_no_variants(spark, made):
    assert spelling_trie.variants(table(spark, made)).count() == 0


def test_words_without_a_neighbour(spark):
    got = spelling_trie.variants(table(spark, [(1, "alone " * 5)])).collect()
    assert [tuple(r) for r in got] == [("alone", None, "alone", 5, 0, None)]


def test_neighbours_of_all_kinds(spark):
    rng = np.random.default_rng(8)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(1, 8))) for _ in range(400)})
    got = [tuple(r) for r in spelling_trie.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if one_edit(a, b))


# --- block whitening ------------------------------------------------------

V = "vec_id bigint, embedding array<float>, row string, x int, n string, component string, at map<string,int>"


def vectors(n=600, dim=20):
    rng = np.random.default_rng(11)
    x = np.float32(rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim)) + 5)
    made = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    made += [(1000 + i, made[7][1]) for i in range(300)]                  # a third are one vector
    made += [(2000, None), (2001, []), (2002, [float("nan")] * dim), (2003, [None, *made[0][1][1:]]),
             (2004, [float("inf"), *made[0][1][1:]]), (2005, [1.0, 2.0]), (None, made[1][1]), (5, made[5][1]), (5, made[6][1])]
    return made


def vector_table(spark, made):
    return spark.createDataFrame([(i, v, "r", 1, "n", "c", {"a": 1}) for i, v in made], V).repartition(4)


def whole(v):
    return [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v]


def test_whitening(spark):
    made = vectors()
    got = block_whitening.whitened(vector_table(spark, made)).collect()
    own = [(i, whole(v)) for i, v in made if v and None not in v and np.isfinite(v).all() and len(v) == 20]
    fit = sorted({tuple(x) for _, x in own})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    assert len(got) == 16 * len(own)
    signs, rows = {}, defaultdict(list)
    for r in got:
        rows[r.vec_id, r.component].append(r)
    assert sorted(c for i, c in rows if i == 0) == list(range(1, 17))
    of = defaultdict(list)
    for i, x in own:
        of[i].append(x)
    for (i, c), found in rows.items():
        assert len(found) == len(of[i])
        want = []
        for x in of[i]:
            z = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vector[:, c - 1] / np.sqrt(value[c - 1])
            want.append((sum((n * a - s) ** 2 for a, s in zip(x, sums)), z))
        if c not in signs:
            signs[c] = np.sign(want[0][1] * found[0].whitened) if len(found) == 1 else 1
        for r, (d, z) in zip(sorted(found, key=lambda r: r.deviation), sorted(want)):
            assert r.n == n and r.deviation == d and abs(r.whitened - signs[c] * z) < 1e-8
            assert abs(r.explained - value[c - 1] / value.sum()) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_whitening_of_flat_and_short_tables(spark):
    flat = [(i, [float(a), float(a) * 2, 3.0]) for i, a in enumerate([1, 2, 2, 9])]  # one direction only
    got = block_whitening.whitened(vector_table(spark, flat)).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in got) == [(i, 1, 3) for i in range(4)]
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in got)
    for made in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        none = block_whitening.whitened(vector_table(spark, made))
        assert none.collect() == [] and none.columns == got[0].__fields__


def test_whitening_of_vast_entries(spark):
    made = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [3.0, 3.0])]
    got = block_whitening.whitened(vector_table(spark, made)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(np.isfinite(r.whitened) for r in got)
