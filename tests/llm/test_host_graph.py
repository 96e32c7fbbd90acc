"""Propagation over a graph of many hosts with a hub and long chains, against
plain power iteration."""

import numpy as np
import pytest

from vitalmart.llm import common, url_graph


def graph(n, chain, seed=5):
    """(source, target) of n hosts: three links each, a hub (0) that links to a
    third of all and is linked by another third, and a chain of the last hosts
    (links to it from outside taken out) that begins at a trusted one and, the
    other way, one that ends at a blocked one."""
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), 3), rng.integers(0, n, 3 * n)
    third = np.arange(1, n // 3)
    a, b = np.concatenate([a, np.zeros_like(third), third + n // 3]), np.concatenate([b, third, np.zeros_like(third)])
    ends = n - 2 * chain
    inside = (a < ends) & (b < ends) & (a != b)
    one, two = np.arange(ends, ends + chain - 1), np.arange(ends + chain, n - 1)
    a, b = np.concatenate([a[inside], one, two, [1]]), np.concatenate([b[inside], one + 1, two + 1, [ends]])
    pairs = np.unique(a * n + b)
    return pairs // n, pairs % n


def plain(a, b, n, seeds, damping):
    """Scores by 400 rounds over all edges."""
    w = 1 / np.bincount(a, minlength=n)[a]
    base = np.zeros(n)
    base[seeds] = (1 - damping) / len(seeds)
    score = base
    for _ in range(400):
        score = base + damping * np.bincount(b, w * score[a], n)
    return score


def test_hub_and_chains(spark):
    n, chain, part, per_bucket = 3000, 40, 100, 2000
    a, b = graph(n, chain)
    trusted, blocked = np.array([1, 7, 8]), np.array([5, 6, n - 1])
    count = lambda x: np.bincount(x, minlength=n)[x]
    edges = spark.createDataFrame(
        [(str(s), str(t), 1 / p, 1 / q) for s, t, p, q in zip(a.tolist(), b.tolist(), count(a).tolist(), count(b).tolist())],
        "source string, target string, share double, back_share double")
    seeds = spark.createDataFrame([(k, str(h), 1 / 3) for k, hs in (("trust", trusted), ("distrust", blocked)) for h in hs],
                                  "kind string, host string, mass double")
    assert url_graph.directed(edges, part).where("part > 0").select("kind", "host").distinct().count() >= 2
    with common.freed(spark):
        got = url_graph.propagate(edges, seeds, part=part, per_bucket=per_bucket).collect()
    for kind, want in (("trust", plain(a, b, n, trusted, .85)), ("distrust", plain(b, a, n, blocked, .85))):
        own = np.zeros(n)
        for r in got:
            if r.kind == kind:
                own[int(r.host)] = r.score
        assert ((own > 0) == (want > 0)).all() and (want > 0).sum() > n // 2
        assert (np.abs(own - want) <= 1e-4 * want).all()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("host_edges_")]


def test_no_edges(spark):
    edges = spark.createDataFrame([], "source string, target string, share double, back_share double")
    seeds = spark.createDataFrame([("trust", "a", 1.0)], "kind string, host string, mass double")
    assert [tuple(r) for r in url_graph.propagate(edges, seeds).collect()] == [("trust", "a", pytest.approx(.15))]
