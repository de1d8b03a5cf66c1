"""URL rules (10) against plain Python."""

import hashlib

from pyspark.sql import functions as F

from cellfold.llm import url_rules
from cellfold.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "https://EXAMPLE.com/en/x?y#z", "x://a.example.com/en/",
        "x://www.example.com/en/a", "x://b.www.example.com/en/a", "x://notexample.com/en/", "x://com.net/es/1", "x://net/fr/",
        "x://a.net/fr", "x://net?/fr/", "x://a.net#/es/", "://x.net/es/", "a://b://c.com/", "x://u@h.com:80/p", "x://.com/",
        "x://example.com./en/", "x://" + "a." * 2000 + "com/" + "d/" * 2000, "x://É.com/é", "x://a.net\n.com/\n", "http://a.net/es/",
        "http://a.net/es/"]


def judge(url, rules=URL_RULES):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_verdicts_on_awkward_urls(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, Rule string").withColumns({"h": F.lit(1), "P": F.lit(2), "best": F.lit(3), "digest": F.lit(4)})
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = url_rules.judge_urls(pages, rules)
    assert out.columns == ["page_id", "url", "h", "P", "best", "digest", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {i: judge(u) for i, u in enumerate(URLS)}


def test_no_rules_no_pages_and_short_prefix_clashes(spark, monkeypatch):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in url_rules.judge_urls(pages, none, default="block").collect()} == {"block"}
    assert url_rules.judge_urls(pages.limit(0), none).count() == 0
    # with an empty short prefix every candidate meets every rule: the full digest decides
    monkeypatch.setattr(url_rules, "PREFIX_HEX", 0)
    rules = URL_RULES + [("a.net", "", "block"), ("net", "/e", "allow"), ("net", "/e", "block"), (None, "/", "block")]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(pages, frame).collect()}
    assert got == {i: judge(u, [r for r in rules if r[0]]) for i, u in enumerate(URLS)}
    assert hashlib.sha256(b"net\x00/e").hexdigest() == spark.range(1).select(
        url_rules._digest(F.lit("net"), F.lit("/e"))).first()[0]
