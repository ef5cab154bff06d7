"""URL rules against a scan of all rules for each url."""

import random

import pytest

from gaugeline.llm import url_filters as uf


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len(h) + len(p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("lanes", [1, 32])
def test_brute_force(spark, lanes):
    rnd = random.Random(6)
    labels = ["com", "org", "a", "b", "x-y", "Ex", "é", ""]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randrange(1, 5)))
    path = lambda: "".join(rnd.choice(["/", "a", "b", "/en/", "%", "_", "é", "\\", "."]) for _ in range(rnd.randrange(6)))
    rules = list({(h, p): (h, p, v) for h, p, v in ((host().lower(), path(), rnd.choice(["allow", "block"])) for _ in range(60)) if h}.values())
    urls = [rnd.choice(["http://", "https://", "x://", "", "//"]) + host() + path() + rnd.choice(["", "?q=/en/", "#x", "?a#b"]) for _ in range(600)]
    urls += [None, "", "://", "http://", "http://com", "http://COM/a://b", "a://b://c/d", "http://com/" + "a" * 50_000] + ["http://a.com/b"] * 5
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, stack string, lane int")
    got = {r.page_id: tuple(r)[1:] for r in uf.judge_urls(pages, uf.rule_table(spark, rules), lanes=lanes).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), u


def test_rules_with_nulls_repeats_and_none(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, "http://b.org/")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("com", "/", "block"), (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    assert sorted([r.verdict for r in uf.judge_urls(pages, rules).collect()]) == ["allow", "block", "block"]
    assert uf.judge_urls(pages, rules.limit(0), default="block").select("verdict").distinct().collect()[0][0] == "block"
    assert uf.judge_urls(pages.limit(0), rules).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    plan = uf.judge_urls(pages, uf.rule_table(spark, uf.RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_the_rules_of_the_query(spark):
    """The contract's five rules as strings, and urls at the edge of com/fr/."""
    assert {(h + p, v) for h, p, v in uf.RULES} == {("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")}
    urls = ["http://a.com/fr/1", "http://a.com/fr", "http://a.com/france", "http://com/fr/", "http://x.com/de/", "https://Example.org/en/12?q", "http://b.example.org/es", "http://org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in uf.judge_urls(pages, uf.rule_table(spark, uf.RULES)).collect()}
    assert got == {0: ("com/fr/", "allow"), 1: (None, "allow"), 2: (None, "allow"), 3: ("com/fr/", "allow"), 4: ("com/de/", "block"),
                   5: ("example.org/en/1", "block"), 6: ("org/", "allow"), 7: (None, "allow")}
