from __future__ import annotations

import random

from starloom.llm.url_filters import judge_urls

RULES = [
    ("net", "/", "block"),
    ("Example.net", "/en/", "allow"),
    ("a.example.net", "/", "block"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
    ("org", "/fr/", "block"),
]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for h, p, v in rules:
        h = h.lower()
        if (host == h or host.endswith("." + h) or h == "") and path.startswith(p):
            fits.append((-len(h + p), -len(h), v, h + p))
    best = min(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def frames(spark, urls, rules):
    pages = spark.createDataFrame(
        [(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, rule string, key string"
    )
    return pages, spark.createDataFrame(rules, "host string, path string, verdict string")


def test_agrees_with_every_rule_tried(spark):
    own = random.Random(5)
    labels = ["a", "b", "example", "net", "org", "com", "network", "www"]
    urls = [
        f"http{own.choice(['', 's'])}://{'.'.join(own.choices(labels, k=own.randint(1, 4)))}"
        f"{own.choice(['', '/', '/en/x', '/de/', '/fr/1?q=/en/', '#/fr/', '?/en/'])}"
        for _ in range(400)
    ]
    urls += ["HTTPS://WWW.Example.NET/en/", None, "", "no-scheme.net/en/", "x://", "a://b://c.net/", "http://net/"] * 3
    urls += ["http://hot.example.net/en/1"] * 300
    rules = RULES + [(f"{x}.{y}", f"/{z}", "block") for x in labels for y in labels for z in ("", "en/")]
    pages, given = frames(spark, urls, rules)
    for ranges in (1, 7):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, given, ranges=ranges).collect()}
        assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_empty_tables_and_empty_hosts(spark):
    pages, rules = frames(spark, ["http://a.b/c", None], RULES)
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    everything = spark.createDataFrame([("", "/", "block")], "host string, path string, verdict string")
    assert sorted((r.page_id, r.verdict) for r in judge_urls(pages, everything).collect()) == [(0, "block"), (1, "allow")]


def test_a_hot_host_is_spread_over_ranges(spark, plan):
    pages, rules = frames(spark, ["http://hot.net/"] * 2000, RULES)
    judged = judge_urls(pages, rules, ranges=8)
    assert max(judged.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) < 1000
    assert "CartesianProduct" not in plan(judged) and "NestedLoop" not in plan(judged)
