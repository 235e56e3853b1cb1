"""Url parsing and rules case by case; propagation against dense matrices."""

import re

import numpy as np

from dialogprep.llm.queries import URL_RULES
from dialogprep.llm.url_filter import judge_urls

ROWS = [
    (1, "https://A.Example.NET/en/x?q=1#f", '<a href="https://good.org/fr/1">x</a><a href="/rel">y</a>'),
    (2, "https://example.net/de/", '<A class="k" HREF=\'//a.example.net/en/\'>x</A>'),
    (3, "http://bad.net", "<a href='http://example.net/'>x</a>"),
    (4, "http://example.com/de", None),
    (5, "http://x.example.com/de/1", '<a href="http://bad.net/x">x</a>' * 3),
    (6, "ftp://good.org/fr/", '<a href="http://hub.com/">x</a>'),
    (7, "http://hub.com/a://b?c", '<a href="http://bad.net/">x</a><a href="HTTP://Good.org">y</a>'),
    (8, None, '<a href="http://bad.net/">x</a>'),
    (9, "no scheme", ""),
    (10, "http://", "x"),
    (11, "http://notexample.net/", '<a href="http://linker.com/">'),
    (12, "http://linker.com/", '<a href="http://bad.net/1">' * 5),
    (12, "http://linker.com/", '<a href="http://bad.net/1">' * 5),
    *[(20 + i, f"http://worse.net/{i}", '<a href="/x">x</a>' * 20) for i in range(9)],
    (40, "http://worse.net?x", None),
    (13, "http://org/fr/\nx", ""),
    (None, "http://ÄB.org/fr/Ä", ""),
]


def plain(rows, rules, damping=0.85, rounds=20):
    parsed = []
    for _, url, html in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        hits = [(-len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        parsed.append((host, path, min(hits, default=None), html or ""))
    hosts, links = set(), {}
    for host, _, _, html in parsed:
        if host:
            hosts.add(host)
            for link in re.findall(r"""(?i)<a\s[^>]*href\s*=\s*["']([^"'>]*)""", html):
                m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)", link)
                if m and m[1].lower() != host:
                    hosts.add(m[1].lower())
                    links[host, m[1].lower()] = links.get((host, m[1].lower()), 0) + 1
    names = sorted(hosts)
    n = len(names)
    w = np.zeros((n, n))
    for (a, b), c in links.items():
        w[names.index(a), names.index(b)] = c
    out = {}
    for kind in ("allow", "block"):
        own = np.eye(n) if kind == "allow" else np.zeros((n, n))
        p = np.array([row / row.sum() if row.sum() else own[i] for i, row in enumerate(w)])
        seed = np.array([np.mean([bool(x[2]) and x[2][2] == kind for x in parsed if x[0] == h] or [0]) for h in names])
        x = seed
        for _ in range(rounds):
            x = (1 - damping) * seed + damping * (x @ p) if kind == "allow" else seed + (1 - seed) * damping * (p @ x)
        out[kind] = dict(zip(names, x.round(6)))
    result = []
    for (i, _, _), (host, path, hit, _) in zip(rows, parsed):
        method = "block" if host and out["block"][host] - out["allow"][host] > 0.5 else "allow"
        t, d = (out["allow"][host], out["block"][host]) if host else (None, None)
        result.append((str(i), host, path, hit[1] if hit else None, hit[2] if hit else method, t, d))
    return sorted(result, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string").repartition(3)
    return sorted(((str(r[0]), *r[1:]) for r in judge_urls(df, URL_RULES, **more).collect()), key=repr)


def same(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert all(a is b is None or abs(a - b) < 2e-6 for a, b in zip(g[5:], w[5:]))


def test_equals_the_dense_model(spark):
    want = plain(ROWS, URL_RULES)
    assert {w[4] for w in want if w[3] is None} == {"allow", "block"}
    same(run(spark, ROWS), want)


def test_without_broadcast_and_empty(spark):
    same(run(spark, ROWS[:6], max_broadcast=0, rounds=3), plain(ROWS[:6], URL_RULES, rounds=3))
    assert run(spark, [], rounds=2) == []


def test_verdicts_compare_between_hosts(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/">x</a>' for h in hosts)
    rows = [
        (1, "http://c.com/", link("a.com")), (2, "http://a.com/", link("b.net")), (3, "http://b.net/", link("good.com", "fine.com")),
        *[(10 + i, f"http://example.com/de/{i}", link("good.com")) for i in range(19)], (30, "http://example.com/en", '<a href="/own">x</a>' * 50),
        (31, "http://linker.com/", link("example.com")),
        (40, "http://many.com/", link("b.net", *[f"h{i}.com" for i in range(9)])), (41, "http://good.com/", None),
    ]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    assert got[2].verdict == "block" and got[2].distrust > got[1].distrust > 0
    assert (got[30].verdict, got[31].verdict) == ("block", "block") and got[30].distrust > 0.9
    assert (got[40].verdict, got[41].verdict) == ("allow", "allow")
    assert all(0 <= r.distrust <= 1 for r in got.values())
