"""URL rules against every rule tried on every page, and the sweep's slices."""

import random

import pytest

from fareloom.llm import urls

PAGES = "page_id long, url string, html string, host string, verdict string, _key string"


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
    stop = min([i for i, c in enumerate(rest) if c in "?#"] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:stop]


def brute(url, rules, default="allow"):
    host, path = cut(url)
    fits = [(len(h + p), len(h), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2] + best[3], best[4] if best else default


def judged(spark, pages, rules, default="allow"):
    given = spark.createDataFrame([(h, p, v, 1) for h, p, v in rules], "host string, path string, verdict string, _row int")
    rows = spark.createDataFrame([(i, u, None, "h", "v", "k") for i, u in pages], PAGES)
    return sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.url_filter(rows, given, default).collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 7, 60])
def test_random_rules_nested_deeply(spark, slices):
    chance = random.Random(slices)
    labels, steps = ["a", "b", "ab", "ü", ""], ["a", "ab", "b/", "/", "é"]

    def host(most):
        return ".".join(chance.choice(labels) for _ in range(chance.randint(1, most)))

    def path(most):
        return "/" + "".join(chance.choice(steps) for _ in range(chance.randint(0, most)))

    rules = {(host(3) or "a", chance.choice(["", path(3)])): chance.choice(["allow", "block"]) for _ in range(150)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    pages = [(i, f"http://{host(5).upper()}{path(5)}{chance.choice(['', '?x=/a', '#://'])}") for i in range(600)]
    pages += [(7, "http://a.b/ab")] * 400  # one host and url with much of the table
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        got = judged(spark, pages, rules)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == sorted(((i, *brute(u, rules)) for i, u in pages), key=repr)


def test_edges(spark):
    pages = [
        (1, None), (2, ""), (3, "net/"), (4, "http://"), (5, "http://NET"), (6, "x://net/"), (6, "x://net/"), (None, "a://b.net/q?r"),
        (8, "h://sub.net./"), (9, "h://a\n.net/\n?"), (10, "http://" + "a." * 5000 + "net/" + "p" * 100_000), (11, "http://xnet/"), (12, "h://k.net/p://q"),
    ]
    rules = [("net", "/", "block"), ("NET", "/", "allow"), ("net", "/p", "allow"), (None, "/", "block"), ("b.net", None, "allow")]
    known = [("net", "/", "block"), ("net", "/p", "allow"), ("b.net", "", "allow")]
    assert judged(spark, pages, rules) == sorted(((i, *brute(u, known)) for i, u in pages), key=repr)
    assert {r[4] for r in judged(spark, pages, [], "block")} == {"block"}
    assert judged(spark, [], rules) == []
