"""URL rules: edge rows against a plain rule walk, test pages against SQL."""

from __future__ import annotations

import re

import duckdb
from pyspark.sql import functions as F

from loanlens.llm import sql, urls
from tests.llm.rows import same_rows

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://a.Example.ORG/es/x", "https://example.org/es", "http://example.org/en/12",
    "http://notexample.org/es/", "http://example.org:80/es/", "http://example.org?q=/es/", "http://shop.com/fr/1", "ftp://x.com/de/?page=1&ref=2",
    "http://x.net/login/", "http://x.net/de/?page=2&ref=x", "http://x.net/a?utm_source=feed", "http://x.net/cart/?sessionid=1", "a://b://c/d",
    "http://x.net/" + "long/" * 5000 + "login/", "http://com/fr/\nnext", "http://x.com/fr/#://", "http://X.COM/FR/", "http://.org/", "http://é.org/ü",
]


def walk(url: str | None) -> tuple:
    after = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(raw) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fits = []
    for r in urls.RULES:
        if r.site:
            h, p = r.text.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((True, len(r.text), r))
        else:
            at, whole = 0, "." + host + after[len(raw) :]
            for part in r.text.split("*"):
                at = whole.find(part, at)
                if at < 0:
                    break
                at += len(part)
            if at >= 0 and url is not None:
                fits.append((False, len(r.text), r))
    best = max(fits, key=lambda x: x[:2])[2] if fits else None
    return host, path, best.text if best and best.site else None, best.verdict if best else urls.DEFAULT


def test_edge_urls(spark):
    pages = spark.createDataFrame([(i % 20, u, "", "mine") for i, u in enumerate([*URLS, URLS[6], URLS[6]])], "page_id long, url string, html string, verdict string")
    got = sorted((tuple(r)[:5] for r in urls.judge(pages).collect()), key=repr)
    assert got == sorted(((i % 20, *walk(u)) for i, u in enumerate([*URLS, URLS[6], URLS[6]])), key=repr)
    assert {"allow", "block"} == {r[4] for r in got}


def test_site_rules_are_those_of_the_contract(spark):
    words = {r.text: r.verdict for r in urls.RULES if r.site}
    assert words == {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    pages = spark.createDataFrame([(1, "http://a.example.org/en/12"), (2, "http://example.org/en/2"), (3, "http://example.org/en/1?utm_source=feed")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages).collect()}
    assert got == {1: ("example.org/en/1", "block"), 2: ("org/", "allow"), 3: ("example.org/en/1", "block")}


def test_tokens_are_whole():
    by_text = {r.text: r.tokens for r in urls.RULES}
    assert by_text["example.org/en/1"] == ["en", "example", "org"]  # the open end "1" may go on
    assert by_text["?page=*&ref="] == ["page", "ref"]
    assert urls.pattern("abc*def", "block").tokens == [""]


def test_rules_without_a_token_still_run(spark):
    pages = spark.createDataFrame([(1, "http://a/xyzabc-def")], "page_id long, url string")
    assert urls.judge(pages, [urls.pattern("abc*def", "block")]).first()["verdict"] == "block"


def test_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    same_rows(urls.judge(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")), con.sql(sql.url_filters()).df())


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(pages).withColumn("x", F.lit(1)).count() == 0
