"""URL filter by rules and propagation over the host graph (operator 13).

Rules (verdict, host, path) decide the URLs they fit: those of the host and its
subdomains whose path starts with the rule's; the longest host wins, then the
longest path. For other URLs the link graph decides:

* Nodes are hosts, edges the links from pages of one host to another, weighted
  by the number of pages that hold them.
* Trust starts at hosts in proportion to the share of their pages that an allow
  rule fits, and follows links: personalised PageRank. Distrust starts in the
  same way at blocked pages and runs against the links, so a host that links to
  blocked hosts is distrusted.
* Masses are told in units: 1 is what a host all of whose pages a rule fits gets
  as a seed alone. So they do not depend on the number of hosts, and a host is
  blocked if its distrust reaches ``least`` and exceeds its trust.

A host that no path joins with a seed keeps trust and distrust 0 and is allowed.

Rules are a table of any size; they are joined with the distinct hosts and what
these are below. Graph and masses are tables too; every round is two joins on the
host and a sum that combines before the shuffle, written to the shared folder.
Rounds stop when the masses move less than ``settled``.

Defined cases: a URL that is null or has no ``://`` has an empty host and path,
fits no rule and is allowed; null html has no links; links within a host, to hosts
without pages and of pages without a host are kept out of the graph or, for
hosts without pages, carry masses like any host; repeated rows count as pages;
null and repeated ids are kept; an empty table gives no rows; other columns are
ignored. A hot host is counted before the shuffle, and its pages meet its verdict
over ``SALTS`` keys. Long URLs and pages are read whole.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.llm.common import stage

#: Keys over which the pages of one host are dealt when they meet what is known of it.
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an absolute or scheme-relative address in a link.
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``rules``, those of the host and of all hosts it is below.
    ``rules`` has ``verdict``, ``host`` and ``path``; only distinct hosts meet them."""
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    told = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.struct(
            F.length("host").alias("host_size"), F.length("path").alias("path_size"), "verdict", F.col("path").alias("path"),
            F.concat(F.translate("host", _UPPER, _LOWER), F.col("path")).alias("rule")).alias("rule")).distinct()
    found = hosts.select("host", F.explode(above).alias("rule_host")).join(told, "rule_host")
    return found.groupBy("host").agg(F.collect_list("rule").alias("rules"))


def _by_host(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``hosts``; the rows of a hot host are dealt over salts."""
    salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["host", "salt"], "left").drop("salt")


def host_edges(pages: DataFrame) -> DataFrame:
    """``source``, ``target`` and ``weight``, the number of pages of one host that
    link to the other. ``pages`` has ``host`` and ``html``."""
    told = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), 1), lambda x: F.translate(x, _UPPER, _LOWER)))
    found = pages.where("host <> ''").select(F.col("host").alias("source"), F.explode(told).alias("target"))
    return found.where("source <> target").groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 40, settled: float = 1e-6) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` in units of a whole seed. ``seeds``:
    the same columns, from 0 to 1. A mass at a host without a further link goes
    back to the seeds."""
    seeds, edges = stage(seeds, "url-seeds"), stage(edges, "url-edges")
    if edges.isEmpty():
        return seeds
    # One copy for each way: a share of the mass at ``at`` goes to ``to``.
    shares = []
    for way, at, to in (("trust", "source", "target"), ("distrust", "target", "source")):
        out = edges.groupBy(at).agg(F.sum("weight").alias("all"))
        shares.append(edges.join(out, at).select(
            F.lit(way).alias("way"), F.col(at).alias("at"), F.col(to).alias("to"), (F.col("weight") / F.col("all")).alias("share")))
    graph = stage(shares[0].unionByName(shares[1]), "url-graph")
    ways = ("trust", "distrust")
    whole = seeds.agg(*[F.sum(w).alias(w) for w in ways]).first().asDict()
    start = stage(seeds.select("host", F.explode(F.array(*[
        F.struct(F.lit(w).alias("way"), (F.col(w) / F.lit(float(whole[w] or 1.0))).alias("mass")) for w in ways])).alias("x")).select(
        "host", "x.way", F.col("x.mass").alias("seed")).where("seed > 0"), "url-start")
    now = start.select("host", "way", F.col("seed").alias("mass"))
    for _ in range(rounds):
        moved = graph.join(now, (graph["at"] == now["host"]) & (graph["way"] == now["way"])).select(
            graph["to"].alias("host"), graph["way"], (F.col("share") * F.col("mass") * damping).alias("mass"))
        moved = stage(moved.groupBy("host", "way").agg(F.sum("mass").alias("mass")), "url-moved")
        sent = {r.way: r.mass for r in moved.groupBy("way").agg(F.sum("mass").alias("mass")).collect()}
        # What was not sent, by damping or for want of links, returns to the seeds.
        kept = {w: max(0.0, 1 - sent.get(w, 0.0)) for w in ways}
        back = F.create_map(*[F.lit(x) for x in chain(*kept.items())])[F.col("way")]
        after = stage(moved.unionByName(start.select("host", "way", (F.col("seed") * back).alias("mass"))).groupBy("host", "way").agg(
            F.sum("mass").alias("mass")), "url-mass")
        change = after.withColumnRenamed("mass", "new").join(now, ["host", "way"], "full").agg(
            F.sum(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("mass", F.lit(0.0))))).first()[0]
        now = after
        if (change or 0.0) < settled:
            break
    # A whole seed gets its part of what returned in the last round.
    sums = [F.coalesce(F.sum(F.when(F.col("way") == w, F.col("mass") * F.lit((whole[w] or 0.0) / kept[w]))), F.lit(0.0)).alias(w)
            for w in ways]
    return now.groupBy("host").agg(*sums)


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          least: float = 0.5) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the ``trust``
    and ``distrust`` of the host (null if no mass reached it)."""
    host, path = host_and_path(pages[url])
    plain = pages.select(pages[page_id].alias("page_id"), host.alias("host"), path.alias("path"), pages[html].alias("html"))
    edges = host_edges(plain)
    plain = plain.drop("html")
    hosts = plain.where("host <> ''").select("host").distinct()
    fits = F.filter("rules", lambda x: F.startswith(F.col("path"), x["path"]))
    # The longest host, then the longest path; of two equal rules that contradict each other, block.
    read = _by_host(plain, rules_of_hosts(hosts, rules)).withColumn("fit", F.array_max(fits)).drop("rules")
    read = stage(read, "url-rules")
    seeds = read.where("host <> ''").groupBy("host").agg(*[
        (F.count(F.when(F.col("fit.verdict") == verdict, 1)) / F.count("*")).alias(name)
        for verdict, name in (("allow", "trust"), ("block", "distrust"))])
    masses = propagate(edges, seeds.where("trust + distrust > 0"))
    bad = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust"))
    return _by_host(read, masses).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
