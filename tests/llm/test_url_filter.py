"""URL rules and propagation against plain Python."""

import re

from parcelmill.llm import urlfilter
from parcelmill.llm.registry import URL_RULES

PAGES = "page_id long, url string, html string, host string, path string, salt int, fit string, trust double"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def run(spark, pages, rules=URL_RULES):
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    return urlfilter.judge(spark.createDataFrame([(*p, "h", "p", 1, "f", 0.5) for p in pages], PAGES).repartition(3), table).collect()


def split(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return m[1].translate(LOWER), m[2]


def rule(host, path, rules):
    fits = [(len(h), len(p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, 0, None, None))[2:]


def brute(pages, rules, least=0.5):
    read = [(i, *split(u), h) for i, u, h in pages]
    fits = [rule(host, path, rules) for _, host, path, _ in read]
    hosts = {x[1] for x in read if x[1]}
    share = lambda h, v: sum(x[1] == h and f[0] == v for x, f in zip(read, fits)) / sum(x[1] == h for x in read)
    edges = {}
    for _, host, _, html in read:
        for to in {x.translate(LOWER) for x in re.findall(r"""(?i)href=["']?(?:[a-z]+:)?//([^/?#"'\s<>]+)""", html or "")}:
            if host and to != host:
                edges[host, to] = edges.get((host, to), 0) + 1
    masses = []
    for verdict, links in (("allow", edges), ("block", {(b, a): w for (a, b), w in edges.items()})):
        seed = {h: share(h, verdict) for h in hosts}
        total = sum(seed.values())
        if not total or not edges:
            masses.append(seed)
            continue
        now = {h: s / total for h, s in seed.items()}
        for _ in range(40):
            after = {}
            for (a, b), w in links.items():
                out = sum(x for (c, _), x in links.items() if c == a)
                after[b] = after.get(b, 0) + 0.85 * now.get(a, 0) * w / out
            kept = 1 - sum(after.values())
            for h, s in seed.items():
                after[h] = after.get(h, 0) + kept * s / total
            now = after
        masses.append({h: m * total / kept for h, m in now.items()})
    told = []
    for (i, host, path, _), (verdict, name) in zip(read, fits):
        trust, bad = (m.get(host, 0) for m in masses)
        told.append((i, host, path, name, verdict or ("block" if bad >= least and bad > trust else "allow")))
    return sorted(told, key=str), masses


HARD = [
    (1, None, None), (2, "", "x"), (3, "no scheme", ""), (4, "http://A.ORG", ""), (5, "http://a.org/", ""), (6, "https://www.Example.org/es/x?y", ""),
    (7, "https://example.org/en/12#t", ""), (8, "https://notexample.org/es/", ""), (9, "x://b.com/fr/://q", ""), (10, "http://b.com/de/", ""),
    (11, "http://com/fr/", ""), (12, "http://b.com:80/fr/", ""), (13, "://", ""), (14, "http://c.net?x=/fr/", ""), (15, "http://ÉA.org/É", ""),
    (15, "http://ÉA.org/É", ""), (None, "http://b.com/de/\nx", ""), (16, "http://a..org//", ""), (17, "http://" + "l" * 5000 + ".org/" + "p" * 90_000, ""),
]


def test_hosts_paths_and_rules(spark):
    got = sorted((tuple(r)[:5] for r in run(spark, HARD)), key=str)
    assert got == brute(HARD, URL_RULES)[0]


def graph():
    link = lambda *hosts: "".join(f'<a HREF="https://{h}/x">t</a><a href=/local>u</a>' for h in hosts)
    pages = [(i, f"http://bad{i}.com/de/", link("bad0.com")) for i in range(3)]
    pages += [(10 + i, f"http://farm{i}.net/", link("BAD0.com", "bad1.com", "bad2.com")) for i in range(2)]
    pages += [(20 + i, f"http://good{i}.org/a", link("shop.net")) for i in range(3)]
    pages += [(30, "http://shop.net/", link("good0.org", "bad1.com")), (31, "http://alone.net/", None), (32, "http://hub.net/", link("farm0.net", "farm1.net"))]
    return pages + [(100 + i, "http://hot.net/p", '<a href="//farm0.net">') for i in range(40)]


def test_propagation_equals_plain_iteration(spark):
    pages = graph()
    want, masses = brute(pages, URL_RULES)
    got = run(spark, pages)
    for r in got:
        for value, mass in zip((r.trust, r.distrust), masses):
            # The same number of rounds on both sides.
            assert abs((value or 0) - mass.get(r.host, 0)) < 1e-6
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    verdicts = {r.host: r.verdict for r in got}
    assert verdicts["farm0.net"] == "block" and verdicts["alone.net"] == "allow" and verdicts["good0.org"] == "allow"


def test_equal_rules_and_empty_table(spark):
    rules = [("allow", "a.org", "/x"), ("block", "A.org", "/x"), ("allow", "a.org", "/xy")]
    got = {r.path: (r.rule, r.verdict) for r in run(spark, [(1, "http://a.org/x1", ""), (2, "http://a.org/xyz", "")], rules)}
    assert got == {"/x1": ("a.org/x", "block"), "/xyz": ("a.org/xy", "allow")}
    assert run(spark, []) == []
