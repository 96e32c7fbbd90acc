"""Every operator on a small table with nulls, empty and long texts, ties,
repeated rows and extra columns, against a plain version; and on an empty one."""

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalmart.llm import (cap_filters, common, exact_topk, language_id, minmax_dedup, mixing, packing, substring_dedup,
                           suffix_dedup, token_output, tokens, url_graph)
from vitalmart.llm.queries import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, row string, part int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdeéß"), rng.integers(1, 8))) for _ in range(n))


def rows():
    base, passage = prose(1, 300), prose(2, 60).capitalize() + "."
    near = base.split(" ")
    near[50], near[200] = "other", "words"
    texts = [base, " ".join(near), base, None, "", " \n\t", "one two", "ONE two", "12 34!", prose(3, 4000),
             "Intro here. " + passage + " Then some more of it.", "Another start. " + passage + " And an end to it all.",
             passage + "\n" + prose(4, 40), "abc " * 500, "This line is here five times.\n" * 5, "<|endoftext|> a's ΣΑΣ İ",
             None]
    out = [(i, t, ["en", "fr", None][i % 3], ["s1", None, "s0", "ä"][i % 4], 1, 2, "x", 3) for i, t in enumerate(texts)]
    return [*out, out[0], out[0], (None, "text without an id here", "en", "s1", 1, 2, "x", 3), (None, None, None, None, 1, 2, "x", 3)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sets(k):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    out = {}
    for d, t, *_ in rows():
        w = WORD.findall((t or "").translate(low))
        out[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def reached(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_near_duplicates(docs, none):
    got = minmax_dedup.near_duplicates(docs, shingle=4).collect()
    own = {d: s for d, s in sets(4).items() if d is not None}
    links = [(a, b) for a in own for b in own if a < b and own[a] and own[b]
             and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])]
    low = reached(own, links)
    assert len(got) == len(rows()) and links
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(own[r.doc_id]), low[r.doc_id], low[r.doc_id] == r.doc_id)
        else:
            assert r.component_id is None and r.kept
    kept = minmax_dedup.one_of_each(docs, shingle=4)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(low.values())) and ids.count(None) == 2
    assert minmax_dedup.near_duplicates(none).count() == 0


def test_cells_hold_all_links():
    rng = np.random.default_rng(0)
    some = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(30)]
    for dense in (1, 4, 128):
        both = minmax_dedup.intersections(some, dense)
        assert all(both[i, j] == (len(np.intersect1d(some[i], some[j])) if i != j else 0)
                   for i in range(30) for j in range(30))


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 440)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = reached({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in want.items() if any(a != b and n in (a, b) for a, b in edges)}


def plain_suffixes(texts, length):
    seen = defaultdict(int)
    for t in texts:
        for s in range(len(t) - length + 1):
            seen[t[s:s + length]] += 1
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                gone[s:s + length] = True
        data = np.frombuffer(t, np.uint8)
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        yield len(t), int(gone.sum()), runs, sha256(data[~gone].tobytes()).hexdigest()


@pytest.mark.parametrize("most, per_target", [(20_000, 100_000), (1, 100_000), (20_000, 5)])
def test_suffixes(docs, none, most, per_target):
    got = suffix_dedup.without_repeats(docs, most=most, per_target=per_target)
    want = list(plain_suffixes([(r[1] or "").encode() for r in rows()], 200))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, ((r[0], *w) for r, w in zip(rows(), want)))) == sorted(
        key((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got.collect())
    assert any(w[1] for w in want) and suffix_dedup.without_repeats(none).count() == 0


def test_loser_tree():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 9):
        runs = []
        for _ in range(k):
            s = sorted(bytes(rng.integers(97, 99, rng.integers(0, 12)).astype(np.uint8)) for _ in range(rng.integers(0, 30)))
            shared, lengths, rest = suffix_dedup.front_coded(s)
            assert suffix_dedup.decoded(shared, lengths, rest) == s
            runs.append((s, shared.tolist()))
        out = list(suffix_dedup.merged(runs))
        strings = [runs[r][0][i] for r, i, _ in out]
        assert strings == sorted(s for r, _ in runs for s in r)
        assert all(h == suffix_dedup.common(a, b) for a, b, (_, _, h) in zip(strings, strings[1:], out[1:]))


def test_lines(docs, none):
    got = substring_dedup.without_repeats(docs)
    assert got.columns == [*docs.columns, "kept_text", "starts", "ends"]
    first, want = {}, {}
    order = sorted({(r[0], r[1]) for r in rows()}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for d, t in order:
        cut = []
        for a, b, digest in substring_dedup.units(t or "", 5):
            if first.setdefault(digest, (d, a)) != (d, a):
                cut.append((a, b))
        keep = np.ones(len(t or ""), bool)
        for a, b in cut:
            keep[a:b] = False
        want[d, t] = t if t is None else "".join(c for c, k in zip(t, keep) if k)
    found = got.collect()
    assert len(found) == len(rows())
    for r in found:
        assert r.kept_text == want[r.doc_id, r.text]
    assert want[14, rows()[14][1]] == "This line is here five times.\n"
    assert substring_dedup.without_repeats(none).count() == 0


def test_lines_of_other_scripts(spark):
    line = "这是一条很长的中文句子里面没有空格也没有标点所以它只算作一个词但是它在许多文章里反复出现"
    said = "他昨天在学校门口遇见了多年不见的老朋友并且谈了很久！"
    # these differ in one vowel sign only
    here, there = "वह मेरी किताब लेकर बाज़ार गया था।", "वह मेरे किताब लेकर बाज़ार गया था।"
    made = [(1, f"{line}\n甲。"), (2, f"开头。{said}结尾。"), (3, here), (4, there), (5, f"乙。\n{line}\n"),
            (6, f"另一篇文章。{said}然后完了。"), (7, here), (8, "Chapter one\n你好世界"), (9, "Chapter one\n你好世界"),
            (10, "Unquestionably institutional responsibilities"), (11, "unquestionably institutional responsibilities!")]
    got = substring_dedup.without_repeats(spark.createDataFrame(made, "doc_id bigint, text string"))
    kept = {r.doc_id: r.kept_text for r in got.collect()}
    assert kept == dict(made) | {5: "乙。\n", 6: "另一篇文章。然后完了。", 7: "", 11: ""}


def ids_of(text, tokenizer):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_added_tokens_by_case(tokenizer):
    texts = ["<|endoftext|> x", "<|ENDOFTEXT|> X", "a<|EndOfText|>b", "a<|endoftext|>b", "A<|endoftext|>B <|"]
    for own in (texts, texts[::-1]):
        raw = [t.encode() for t in own]
        offsets = np.cumsum([0, *map(len, raw)])
        ids, n = tokens.Encoder(tokenizer_path()).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in own]


def test_token_files(spark, docs, none, tokenizer, tmp_path):
    token_output.write_tokens(docs, f"{tmp_path}/a", tokenizer_path(), 2, chunk=500)
    got = sorted(token_output.read_tokens(spark, f"{tmp_path}/a", with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows()), key=lambda d: (d is not None, d or 0))
    assert sorted(tuple(r.ids) for r in got) == sorted(tuple(ids_of(r[1], tokenizer).tolist()) for r in rows())
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    token_output.write_tokens(none, f"{tmp_path}/b", tokenizer_path(), 2)
    assert token_output.read_tokens(spark, f"{tmp_path}/b").count() == 0


def test_packing(docs, none, tokenizer):
    got = packing.packed(docs, tokenizer_path(), window=64).collect()
    texts = defaultdict(list)
    for r in rows():
        texts[r[0]].append(ids_of(r[1], tokenizer))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert sum(64 - sum(r.length for r in s) for s in sequences.values()) < 64
    for d, own in texts.items():
        assert sum(r.length for r in pieces[d]) == sum(map(len, own))
        for r in pieces[d]:
            assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                       for x in own)
    assert packing.packed(none, tokenizer_path()).count() == 0


def test_languages(spark, docs, none):
    rng = np.random.default_rng(1)
    kinds = {"aa": "abcde ", "bb": "fghij ", "cc": "éßüök "}
    made = [(i, "".join(rng.choice(list(kinds[k]), 60)), k) for i, k in enumerate(rng.choice(list(kinds), 300))]
    made += [(900, None, "aa"), (901, "123 !", "bb"), (902, "abcde abc", None), (None, "abc", "aa")]
    got = {r.doc_id: r for r in language_id.languages(spark.createDataFrame(made, "doc_id bigint, text string, lang string")).collect()}
    assert len(got) == len(made)
    held = [d for d, _, _ in made[:300] if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d].held_out == (d in held) for d, _, _ in made[:300])
    assert np.mean([got[d].lang_pred == made[d][2] for d in held]) > 0.95
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "aa"
    known = language_id.known(docs)
    assert known.columns == docs.columns and None not in [r.text for r in known.collect()]
    assert language_id.languages(none).count() == 0


def test_no_language_learned(docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    got = language_id.known(unlabelled)
    want = [r[1] for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert want and got.columns == docs.columns and sorted(r.text for r in got.collect()) == sorted(want)


def test_mixing(docs, none):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows()) and sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))
    sizes = defaultdict(int)
    for r in rows():
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    goal = mixing.targets(sizes)
    assert abs(sum(goal.values()) - sum(sizes.values())) < 1e-6 and all(goal[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    for r in got:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size and abs(r.target - goal[r.source]) < 1e-9
    assert sum(r.taken for r in got) <= sum(sizes.values())
    out = mixing.sampled(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    assert mixing.mixed(none).count() == 0


def test_mixing_of_sources_without_words(spark):
    blank = [(1, None, "s0"), (2, "", "s0"), (3, " \n\t", "s0"), (4, "  ", None)]
    made = [*blank, (5, "one two three", "s1"), (6, "four", "s2")]
    got = {r.doc_id: r for r in mixing.mixed(spark.createDataFrame(made, "doc_id bigint, text string, source string")).collect()}
    assert len(got) == len(made)
    goal = mixing.targets({"s0": 0, None: 0, "s1": 3, "s2": 1})
    for d, _, s in made:
        assert abs(got[d].target - goal[s]) < 1e-9
    for d, _, _ in blank:
        assert (got[d].size, got[d].source_size, got[d].target, got[d].copies, got[d].taken) == (0, 0, 0, 0, 0)
    assert got[5].taken + got[6].taken > 0
    only = spark.createDataFrame(blank, "doc_id bigint, text string, source string")
    assert [(r.copies, r.taken) for r in mixing.mixed(only).collect()] == [(0, 0)] * len(blank)
    assert mixing.sampled(only).count() == 0


def vectors(n=400):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((n, 16))
    for i in range(1, n, 3):
        x[i] = x[i - 1] + 0.03 * rng.standard_normal(16)
    out = [(i, [float(v) for v in np.float32(r)], int(i // 60), "extra") for i, r in enumerate(x)]
    out += [(1000, None, 1, "e"), (1001, [0.0] * 16, 1, "e"), (1002, [float("nan")] * 16, 1, "e"), (1003, [1.0, None], 1, "e"),
            (1004, [1.0, 2.0], 1, "e"), (1005, out[0][1], 0, "e"), (1006, out[0][1], None, "e"), (1050, out[3][1], 0, "e")]
    return out


V = "vec_id bigint, embedding array<float>, label int, rank string"


def test_links(spark):
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cap_filters.linked(spark.createDataFrame(vectors(), V)).collect()}
    own = [(i, np.array(v, np.float32).astype(float), c) for i, v, c, _ in vectors() if v and c is not None and None not in v]
    links = []
    for i, v, c in own:
        for j, w, e in own:
            if i < j and c == e and len(v) == len(w) and np.linalg.norm(v) * np.linalg.norm(w) > 0:
                if v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                    links.append((i, j))
    low = reached([r[0] for r in vectors()], links)
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert links and got == {i: (n[i], low[i], low[i] == i) for i in low}
    assert cap_filters.linked(spark.createDataFrame([], V)).count() == 0


@pytest.mark.parametrize("block", [4096, 50])
def test_top_k(spark, block):
    got = exact_topk.nearest(spark.createDataFrame(vectors(), V), F.col("vec_id") % 50 == 0, block=block).collect()
    own = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v, _, _ in vectors()
           if v and None not in v and np.isfinite(v).all()]
    want = []
    for i, v in own:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in own if j != i and len(w) == len(v))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert exact_topk.nearest(spark.createDataFrame([], V), F.col("vec_id") % 50 == 0).count() == 0


def test_urls(spark):
    page = lambda *to: "".join(f'<A class=x HREF="http://{h}/p">t</A>' for h in to)
    made = [(1, "http://WWW.Example.com/en/x?y", page("a.org"), "e"), (2, "https://example.com/en/", None, "e"),
            (3, "http://shop.example.com/fr/", "", "e"), (4, "http://x.net/es/1", page("x.net"), "e"), (5, "http://x.net/fr/2", "", "e"),
            (6, "http://x.net/de/2", "", "e"), (7, "http://bad.org/q", page("x.net", "c.org"), "e"),
            (8, "http://a.org/", page("c.org"), "e"), (9, None, page("x.net"), "e"), (10, "no scheme", "", "e"),
            (11, "http://c.org#f", page("d.org"), "e"), (12, "http://d.org", None, "e"), (12, "http://d.org", None, "e")]
    got = sorted(url_graph.judged(spark.createDataFrame(made, "page_id bigint, url string, html string, host string")).collect(),
                 key=lambda r: r.page_id)
    assert [(r.host, r.path, r.rule) for r in got[:3]] == [
        ("www.example.com", "/en/x", "www.example.com/en/"), ("example.com", "/en/", "example.com/en/"),
        ("shop.example.com", "/fr/", "com/")]
    verdict = {r.page_id: r.verdict for r in got}
    # bad.org links to the blocked x.net; a.org is linked from a trusted host
    assert [verdict[k] for k in range(1, 13)] == ["allow", "block", "allow", "block", "block", "block", "block", "allow",
                                                  "allow", "allow", "allow", "allow"]
    # plain propagation over the same host edges
    edges = {("www.example.com", "a.org"): 1, ("bad.org", "x.net"): .5, ("bad.org", "c.org"): .5, ("a.org", "c.org"): 1,
             ("c.org", "d.org"): 1}
    seeds = {"www.example.com": .5, "shop.example.com": .5}
    trust = {h: .15 * m for h, m in seeds.items()}
    for _ in range(30):
        new = {h: .15 * m for h, m in seeds.items()}
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0) + .85 * w * trust.get(a, 0)
        trust = new
    for r in got:
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-6
    assert url_graph.judged(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_verdicts_do_not_depend_on_size(spark):
    """A graph beside 199 others of its kind; hosts 30 links off; a cycle."""
    page = lambda to: "".join(f"<a href='//{h}/'>t</a>" * n for h, n in to.items())

    def copy(k):  # a2 is one of 1,001 links to a1, which is one of 1,001 to the blocked x
        return [(f"http://x{k}.net/es/", ""), (f"http://b{k}.org/", page({f"x{k}.net": 1000, f"a1{k}.org": 1000})),
                (f"http://a1{k}.org/", page({f"x{k}.net": 1})), (f"http://a2{k}.org/", page({f"a1{k}.org": 1}))]

    far = [(f"http://h{i}.org/", page({f"h{i - 1}.org" if i else "x0.net": 1})) for i in range(30)]
    cycle = [("http://p.com/", page({"q.org": 1})), ("http://q.org/", page({"r.org": 1})), ("http://r.org/", page({"q.org": 1}))]
    for copies in (1, 200):
        made = [(i, *row) for i, row in enumerate([*far, *cycle, *(r for k in range(copies) for r in copy(k))])]
        got = url_graph.judged(spark.createDataFrame(made, "page_id bigint, url string, html string")).collect()
        by_host = {r.host: r for r in got}
        allowed = {h for h, r in by_host.items() if r.verdict == "allow"}
        assert len(got) == len(made) and allowed == {"p.com", "q.org", "r.org"}
        # q = 0.85 * (p + r), r = 0.85 * q, to the end
        q = .85 * .15 / (1 - .85 ** 2)
        assert abs(by_host["q.org"].trust - q) < 1e-5 * q and abs(by_host["r.org"].trust - .85 * q) < 1e-5 * q
