"""Operator 7 against its SQL, a plain search over all rules, and edge cases."""

import itertools

import pytest
from compare import differences
from pyspark.sql import functions as F

from clicktide.llm.registry import ORACLES, op7_url_filter
from clicktide.llm.urls import UPPER, split_url, url_filter

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "", "allow"),
    ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("a.com", "/fr/", "block"),
    ("a.com", "/fr/", "allow"), ("Net", "", "block"), ("x.net", "/a/b/c", "allow"),
    (None, "/", "allow"), ("", "/", "block"), ("com", "x", "block"), ("com", "/", "maybe"),
]
URLS = [
    None, "", "example.org/es/", "://", "http://", "http:///es/x", "HTTP://EXAMPLE.org/es/",
    "http://example.org", "http://example.org?x=/es/", "http://www.example.org/en/123#/es/",
    "http://notexample.org/es/", "http://a.com/fr/x", "http://b.a.com/fr", "http://com/fr/",
    "http://x.net/a/b/cd/e", "http://x.net/a/b", "http://u://v.net/", "http://é.NET/ü?",
    "http://example.org./es/", "http://example.org:80/es/", "x://y.org/" + "s/" * 20_000,
    "http://example.org/en/1", "http://example.org/en/1",
]


def plain(url):
    host, path = split_url(url)
    best = None
    for h, p, v in RULES:
        if not h or v not in ("allow", "block") or (p and p[0] != "/"):
            continue
        h = h.translate(UPPER)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), v == "block")
            if best is None or key > best[0]:
                best = (key, h + p, v)
    return (host, path, *(best[1:] if best else (None, "allow" if host else "block")))


@pytest.mark.parametrize("block_rules", [100, 3])
def test_against_plain(spark, block_rules):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    pages = pages.withColumns({"Host": F.lit(1), "h": F.lit(2), "p": F.lit(3)})
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = url_filter(pages, rules, block_rules=block_rules)
    assert out.columns == ["page_id", "url", "h", "p", "host", "path", "rule", "verdict"]
    rows = out.orderBy("page_id").select("host", "path", "rule", "verdict").collect()
    for url, row in itertools.zip_longest(URLS, rows):
        assert tuple(row) == plain(url), url


def test_empty_tables(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter(pages.limit(0), rules).count() == 0
    assert url_filter(pages, rules.limit(0)).where("rule IS NOT NULL").count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, data, sf):
    folder = data.replace("sf0.001", sf)
    assert differences(op7_url_filter(spark, folder), ORACLES["op7_url_filter"], folder) == ""
