"""URL filters by link-graph propagation.

Rules decide the urls that they fit. Every other url gets the verdict of its
host: trust is personalised PageRank over host edges from trusted seeds,
distrust the same over reversed edges from blocked seeds, so a host that
links to blocked hosts, over however many steps, gathers distrust. A host
with more distrust than trust is blocked.

All of it is DataFrame work; the graph is reduced to one row per pair of
hosts before anything is iterated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import dropped, saved, scratch

#: (rule, verdict): host, from the first slash on the path.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
#: What is passed on below this ends there: the range of doubles (at 0.85,
#: some 4,200 undivided links).
TINY = 1e-300
#: Edges of a host that one part holds, and of the table that one bucket does
#: (the buckets of a table are at most what Spark allows by default).
PART, PER_BUCKET, MOST_BUCKETS = 100_000, 1_000_000, 100_000
#: Steps between two looks at whether any host has something left to pass on.
STEPS = 4
#: Scores that differ by less than this part of them are alike.
ALIKE = 1e-4
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    low = F.translate(F.regexp_extract(url, _URL, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, share): the part of a host's links to other hosts that
    goes to each; from the hosts of ``pages`` (host, html)."""
    to = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1))).alias("link")
    pairs = saved(pages.select(F.col("host").alias("source"), to)
                  .withColumn("target", host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link"))
                                                .otherwise(F.col("link"))))
                  .where("source <> '' AND target <> '' AND source <> target")
                  .groupBy("source", "target").agg(F.count(F.lit(1)).alias("n")))
    total = pairs.groupBy("source").agg(F.sum("n").alias("all"))
    back = pairs.groupBy("target").agg(F.sum("n").alias("back"))
    return (pairs.join(total, "source").join(back, "target")
            .select("source", "target", (F.col("n") / F.col("all")).alias("share"),
                    (F.col("n") / F.col("back")).alias("back_share")))


def directed(edges: DataFrame, part: int = PART) -> DataFrame:
    """(kind, host, part, to, w, to_parts): 'trust' along the edges, 'distrust'
    against them. The edges of a host with more than ``part`` of them are dealt
    out in parts of about that many by their other end; ``to_parts`` is the
    number of parts that the other end's own edges have."""
    flow = saved(edges.select(F.lit("trust").alias("kind"), F.col("source").alias("host"),
                              F.col("target").alias("to"), F.col("share").alias("w"))
                 .union(edges.select(F.lit("distrust"), "target", "source", "back_share")))
    hubs = saved(flow.groupBy("kind", "host").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
                 .where("parts > 1"))
    ends = hubs.select("kind", F.col("host").alias("to"), F.col("parts").alias("to_parts"))
    return (flow.join(hubs, ["kind", "host"], "left").join(ends, ["kind", "to"], "left")
            .select("kind", "host", F.pmod(F.xxhash64("to"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
                    "to", "w", F.coalesce("to_parts", F.lit(1)).alias("to_parts")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, settled: float = 1e-6,
              part: int = PART, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(kind, host, score) from seeds (kind, host, mass): 'trust' flows along
    edges, 'distrust' against them; a host keeps 1 - damping of the seeds and
    passes damping of all that reaches it on.

    The edges are written once, bucketed by (kind, host, part), and never
    shuffled again. In each step only hosts with more left to pass on than
    ``settled`` of their score do so, all that they have, until there is none:
    a long chain costs steps of a few rows, and no size of the graph or number
    of seeds ends it early. What stays unpassed is at most ``settled`` of a
    host's score, so a score falls short by about that part for each link that
    its mass has come over.
    """
    spark = edges.sparkSession
    name = f"host_edges_{uuid.uuid4().hex}"
    flow = saved(directed(edges, part))
    n = flow.count()
    own = flow.select("kind", F.col("to").alias("host"), "to_parts").where("to_parts > 1").distinct()
    first = (1 - damping) * F.col("mass")
    state = saved(seeds.join(own, ["kind", "host"], "left")
                  .select("kind", "host", F.coalesce("to_parts", F.lit(1)).alias("parts"),
                          first.alias("score"), first.alias("rest")))
    if not n:
        return state.select("kind", "host", "score")
    buckets, keys = min(-(-n // per_bucket), MOST_BUCKETS), ["kind", "host", "part"]
    with scratch(spark) as path:
        try:
            (flow.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
             .option("path", path).format("parquet").saveAsTable(name))
            dropped(flow)
            flow = spark.table(name)
            active = F.col("rest") > settled * F.col("score")
            left = F.when(active, 0.0).otherwise(F.col("rest"))
            while not state.where(active).isEmpty():
                for _ in range(STEPS):  # one that has nothing to pass on changes nothing
                    sent = (state.where(active)
                            .select("kind", "host", "rest", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
                            .join(flow, keys)
                            .select("kind", F.col("to").alias("host"), F.col("to_parts").alias("parts"),
                                    (damping * F.col("w") * F.col("rest")).alias("score"))
                            .where(F.col("score") > TINY))
                    before, state = state, saved(
                        state.select("kind", "host", "parts", "score", left.alias("rest"))
                        .union(sent.withColumn("rest", F.col("score")))
                        .groupBy("kind", "host").agg(F.max("parts").alias("parts"), F.sum("score").alias("score"),
                                                     F.sum("rest").alias("rest")))
                    dropped(before)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return state.select("kind", "host", "score")


def judged(pages: DataFrame, rules=RULES, damping: float = 0.85, majority: float = 0.5) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule,
    verdict, trust, distrust.

    Seeds: hosts of which more than ``majority`` of the urls are allowed
    (trusted) or blocked (blocked) by a rule, each kind sharing a mass of 1.
    Urls without a rule: ``block`` where the host's distrust exceeds its trust
    (by more than ``ALIKE`` of it, so that sums added up in another order judge
    alike), however little it is, else ``allow``. Null url or no ``://``: host and
    path empty, no rule, allowed. Null html: no links. Repeated rows are
    judged one by one. Empty table: no rows.
    """
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    named = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(v) for rule in rules for v in rule])
    ruled = F.element_at(verdicts, F.col("rule"))
    hosts = saved(named.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(ruled == "allow", 1)).alias("allowed"),
        F.count(F.when(ruled == "block", 1)).alias("blocked")))
    seeds = (hosts.where(F.col("allowed") > majority * F.col("n")).select(F.lit("trust").alias("kind"), "host")
             .union(hosts.where(F.col("blocked") > majority * F.col("n")).select(F.lit("distrust"), "host")))
    masses = seeds.groupBy("kind").agg((1 / F.count(F.lit(1))).alias("mass"))
    score = propagate(host_edges(named), seeds.join(F.broadcast(masses), "kind"), damping)
    by_host = score.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"))
    zero = F.lit(0.0)
    out = named.drop("html").join(by_host, "host", "left")
    trust, distrust = F.coalesce("trust", zero), F.coalesce("distrust", zero)
    by_links = F.when(distrust > (1 + ALIKE) * trust, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce(ruled, by_links).alias("verdict"),
                      trust.alias("trust"), distrust.alias("distrust"))
