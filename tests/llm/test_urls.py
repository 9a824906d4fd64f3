"""The sweep against a plain loop over all rules."""

import random

import pytest

from millrace.llm import urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host):]
        for c in "?#":
            path = path.split(c)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, action in rules:
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), [-ord(c) for c in h + p], action == "allow")
            if best is None or rank > best[0]:
                best = (rank, h + p, action)
    return host, path, best and best[1], best[2] if best else default


def test_rows(spark):
    rng = random.Random(5)
    hosts = ["a.example.net", "example.net", "Example.NET", "net", "xnet", "x.org", "org", "example.com", "m.example.com",
             "example.com.org", "", "a..net", "net.", "b.a.example.net:80", "zz.net"]
    made = [None, "", "no url", "http://", "://net/", "http://net", "http://net?x=/", "x://y.net/a://b/c", "http://a.net#/en/",
            "line\nhttp://a.net/x\ny?z"]
    made += [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en/1?x', '/de/2#a', '/fr/', '/EN/', '?/en/'])}"
             for _ in range(400)]
    rows = [(i, u, i, "clash") for i, u in enumerate(made)] + [(0, None, 0, "clash"), (None, "http://a.net/", 1, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, key long, rule string")
    many = RULES + [("a.example.net", "/", "block"), ("example.net", "/", "allow"), ("", "/", "block"), ("net", "/", "allow")]
    for rules in (RULES, many, []):
        table = spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, action string")
        got = urls.judge(pages, table).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *plain(r[1], rules))) for r in rows)
    assert urls.judge(pages.limit(0), table).count() == 0
