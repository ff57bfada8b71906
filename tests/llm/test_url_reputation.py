import math

import pytest
from pyspark.sql import functions as F

from trawl.llm import url_reputation as ur
from trawl.llm.queries import QUERIES


def split_url(url):
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:] if rest[cut:cut + 1] == "/" else ""
    return low(rest[:cut]), path.split("?")[0].split("#")[0]


def rule_of(host, path):
    best = None
    for verdict, rule in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")):
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


URLS = [None, "", "no scheme", "http://", "http://A.B.Example.NET/en/x?y#z", "http://example.net", "http://example.net?en/", "://net/",
        "http://xnet/", "x\ny://example.com/de/#a", "http://example.com/De/", "a://b://c.org/fr/", "http://org/fr/", "http://ÀB.org/fr",
        "https://shop.co.uk/a", "https://www.shop.co.uk/", "https://co.uk/", "http://u:p@h.example.net:80/en/", "http://example.net/en"]


def test_rules(spark, make_dir):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in QUERIES["op5_host_reputation"](spark, make_dir([], pages=pages, labels=labels)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = split_url(u)
        rule = rule_of(host, path)
        assert (got[i].host, got[i].path) == (host, path), u
        assert (got[i].rule, got[i].verdict) == ((rule[1], rule[0]) if rule else (None, "allow")), u


def test_domains(spark):
    rows = [("a.b.c.com", "c.com", "com"), ("c.com", "c.com", "com"), ("com", "com", "com"), ("", "", ""),
            ("x.shop.co.uk", "shop.co.uk", "co.uk"), ("shop.co.uk", "shop.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk")]
    df = spark.createDataFrame(rows, "host string, d string, s string")
    bad = df.where((ur.domain_of(F.col("host")) != F.col("d")) | (ur.suffix_of(F.col("host")) != F.col("s")))
    assert bad.count() == 0


def slow_reputation(hosts):
    """hosts: {host: (bad, n)} -> {host: (mean, low)}, level by level."""
    def level(children, means):
        over = sum(n * (b / n - means[p]) ** 2 - means[p] * (1 - means[p]) for p, b, n in children.values() if n)
        most = sum(means[p] * (1 - means[p]) * (n - 1) for p, b, n in children.values() if n)
        w = 1000.0 if over <= 1e-12 else max(2.0, min(1000.0, most / over - 1))
        return {c: (w * means[p] + b, w * (1 - means[p]) + n - b) for c, (p, b, n) in children.items()}

    dom = lambda h: ".".join(h.split(".")[-2:])
    suf = lambda h: h.split(".")[-1]
    total = lambda key, src: {k: (sum(b for h, (b, n) in src.items() if key(h) == k), sum(n for h, (b, n) in src.items() if key(h) == k)) for k in {key(h) for h in src}}  # noqa: E731, E501
    domains, suffixes = total(dom, hosts), total(suf, hosts)
    top = (sum(b for b, _ in suffixes.values()) + 1) / (sum(n for _, n in suffixes.values()) + 2)
    mean = lambda ab: {k: a / (a + b) for k, (a, b) in ab.items()}
    s = mean(level({k: ("", b, n) for k, (b, n) in suffixes.items()}, {"": top}))
    d = mean(level({k: (suf(k), b, n) for k, (b, n) in domains.items()}, s))
    h = level({k: (dom(k), b, n) for k, (b, n) in hosts.items()}, d)
    return {k: (a / (a + b), max(0.0, a / (a + b) - 1.645 * math.sqrt(a * b / (a + b) ** 2 / (a + b + 1)))) for k, (a, b) in h.items()}


def test_shrinkage_against_slow(spark):
    hosts = {"a.x.com": (0, 40), "b.x.com": (38, 40), "c.x.com": (1, 1), "x.com": (0, 0), "y.com": (0, 0), "a.y.com": (3, 9),
             "z.info": (90, 100), "w.z.info": (0, 0), "new.info": (0, 0)}
    pages, outcomes, i = [], [], 0
    for h, (bad, n) in hosts.items():
        for k in range(max(n, 1)):
            i += 1
            pages.append((i, f"http://{h}/p{k}"))
            if k < n:
                outcomes.append((i, int(k < bad)))
    outcomes += [(None, 1), (1, None), (10**9, 1)]
    p = spark.createDataFrame(pages, "page_id long, url string")
    o = spark.createDataFrame(outcomes, "page_id long, bad int")
    got = {r.host: r for r in ur.reputation(p, o).collect()}
    want = slow_reputation(hosts)
    assert set(got) == set(want)
    for h, (m, low) in want.items():
        assert (got[h].n_bad, got[h].n_labelled) == hosts[h]
        assert got[h].bad_mean == pytest.approx(m, abs=2e-6) and got[h].bad_low == pytest.approx(low, abs=2e-6)
    verdicts = {r.host: r.verdict for r in ur.judge(p, o).collect()}
    assert verdicts["b.x.com"] == "block" and verdicts["a.x.com"] == "allow" and verdicts["z.info"] == "block"


def test_empty(spark):
    p = spark.createDataFrame([], "page_id long, url string")
    o = spark.createDataFrame([], "page_id long, bad int")
    assert ur.judge(p, o).count() == 0
    two = spark.createDataFrame([(1, "http://a.de/"), (1, "http://a.de/")], "page_id long, url string")
    assert [r.verdict for r in ur.judge(two, o).collect()] == ["allow", "allow"]
