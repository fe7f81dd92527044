import math

import pytest

from tracklens.llm import url_reputation as U

SCHEMA = "page_id long, url string, mean string, bound string, ruled string, n string, k string"
URLS = [
    None, "", "no scheme", "ftp", "http://", "HTTP://WWW.Example.ORG/es/Page?x#y", "https://example.org/en/10", "https://example.org:80/es/",
    "http://a.b.c.org/x", "http://a.b.c.org/x", "http://shop.com/fr/1", "http://shop.com/fr/2", "http://shop.com/de/1", "http://bad.com/de/", "http://bad.com/de/2",
    "http://bad.com/de/3", "http://bad.com/other", "http://sub.bad.com/other", "http://other.net/fr/", "http://other.net", "http://lone", "x://?q", "y:///path", "http://com/fr/",
    "http://notexample.org/es/", "http://xexample.org/en/1", "http://a.com#/fr/", "http://ÄÖ.com/fr/é", "://empty.scheme.org/", "a://b://c.org/",
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def posterior(level, mu):
    """(mean, strength) of (n, s) groups that share the parent means ``mu``."""
    seen = [g for g in level if level[g][0]]
    a = sum(level[g][0] * (level[g][1] / level[g][0] - mu[g]) ** 2 for g in seen)
    b = sum(mu[g] * (1 - mu[g]) for g in seen)
    c = sum(mu[g] * (1 - mu[g]) * (level[g][0] - 1) for g in seen)
    rho = min(max((a - b) / c if c > 0 else 0.5, U.RHO_RANGE[0]), U.RHO_RANGE[1])
    k = 1 / rho - 1
    return {g: ((k * mu[g] + s) / (k + n), k + n) for g, (n, s) in level.items()}


def brute(rows):
    pages = [(i, *parse(u)) for i, u in rows]
    hosts = {}
    for _, h, p in pages:
        n, s = hosts.get(h, (0, 0))
        v = rule_of(h, p)[1]
        hosts[h] = (n + (v is not None), s + (v == "allow"))
    up = lambda key: [".".join(key.split(".")[-2:]), key.split(".")[-1], ""]
    levels = [{}, {}, {}]
    for h, (n, s) in hosts.items():
        for level, g in zip(levels, up(h), strict=True):
            level[g] = (level.get(g, (0, 0))[0] + n, level.get(g, (0, 0))[1] + s)
    domains, suffixes, root = levels
    root = posterior(root, {"": 0.5})
    suffixes = posterior(suffixes, {g: root[""][0] for g in suffixes})
    domains = posterior(domains, {g: suffixes[g.split(".")[-1]][0] for g in domains})
    posts = posterior(hosts, {h: domains[up(h)[0]][0] for h in hosts})
    out = []
    for i, h, p in pages:
        m, w = posts[h]
        bound = m - U.Z * math.sqrt(m * (1 - m) / (w + 1))
        rule, ruled = rule_of(h, p)
        out.append((i, h, p, rule, ruled or ("allow" if round(bound, 6) >= U.MIN_BOUND else "block"), m, bound))
    return sorted(out, key=lambda r: (r[0], str(r)))


def run(spark, rows):
    df = spark.createDataFrame([(i, u, "m", "b", "r", "n", "k") for i, u in rows], SCHEMA).repartition(3)
    got = U.judge_urls(df)
    assert got.columns == [*df.columns, "host", "path", "rule", "verdict", "posterior_mean", "posterior_bound"]
    out = got.collect()
    assert all((r["mean"], r["bound"], r.ruled, r.n, r.k) == ("m", "b", "r", "n", "k") for r in out)
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.posterior_mean, r.posterior_bound) for r in out), key=lambda r: (r[0], str(r)))


@pytest.mark.parametrize("urls", [URLS, [u for u in URLS if u and "/" not in u[-8:]], ["http://same.com/x"] * 5, [None]])
def test_posterior_against_brute_force(spark, urls):
    rows = list(enumerate(urls)) + [(0, urls[0])]  # a repeated row
    for got, expected in zip(run(spark, rows), brute(rows), strict=True):
        assert got[:5] == expected[:5]
        assert got[5:] == pytest.approx(expected[5:], abs=2e-6)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_own_columns_are_replaced(spark):
    df = spark.createDataFrame([("http://a.org/", "old", "old")], "url string, host string, verdict string")
    row = U.judge_urls(df).first()
    assert (row.host, row.verdict) == ("a.org", "allow")


def test_rules_are_bounded():
    with pytest.raises(ValueError, match="at most"):
        U.rule_columns(None, None, [("allow", "org", "/")] * (U.MAX_RULES + 1))
