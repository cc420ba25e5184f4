from __future__ import annotations

import re

from pyspark.sql import functions as F

from gridtide.llm.queries import URL_RULES
from gridtide.llm.url_filter import RULE_SCHEMA, filter_urls

URLS = [
    "http://a.net/x", "https://Example.NET/en/1", "http://www.example.net/de/", "http://net/",
    "http://net", "http://xnet/", "ftp://b.org/fr/", "http://b.org/fr", "http://u@c.example.com:80/de/",
    "http://c.example.com/de/?q=/x", "http://c.example.com?x=/de/", "http://example.com/DE/",
    "no scheme", "", None, "a://b://c.net/", "http:///de/", "http://a..net/", "http://a.net./",
    "http://" + "a." * 20_000 + "net/" + "x/" * 20_000, "http://net/\n/x#y", "http://İ.NET/",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p) and host
    ]
    return (host, path, *max(fits)[3:]) if fits else (host, path, None, "allow")


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "n long, url string")
    pages = pages.withColumns({"host": F.lit("clash"), "verdict": F.lit("clash"), "digest": F.lit(1)})
    got = filter_urls(pages, spark.createDataFrame(rules, RULE_SCHEMA)).collect()
    return {r.n: (r.host, r.path, r.rule, r.verdict) for r in got}


def test_equals_brute_force(spark):
    rules = [*URL_RULES, ("a.net", "/x", "allow"), ("net", "/x", "allow"), ("b.net", "", "block")]
    for some in (URL_RULES, rules, [("net", "/", "allow"), ("net", "/", "block")]):
        assert judged(spark, URLS, some) == {n: brute(u, some) for n, u in enumerate(URLS)}


def test_no_rules_no_pages_repeated_pages(spark):
    assert judged(spark, ["http://a.net/"], []) == {0: ("a.net", "/", None, "allow")}
    assert judged(spark, [], URL_RULES) == {}
    pages = spark.createDataFrame([("http://a.net/",)] * 3, "url string")
    rules = spark.createDataFrame(URL_RULES, RULE_SCHEMA)
    assert filter_urls(pages, rules).where("verdict = 'block'").count() == 3


def test_main_path_has_no_python(spark):
    pages = spark.createDataFrame([("http://a.net/",)], "url string")
    rules = spark.createDataFrame(URL_RULES, RULE_SCHEMA)
    plan = filter_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
