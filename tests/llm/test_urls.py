"""Host, path and rule against a slow definition; verdicts of rules and of trees."""

import re

import pytest
from pyspark.sql import functions as F

from merclake.llm import urls
from merclake.llm.common import documents

SF = "/root/testdata/sf0.01"


def slow(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len) if fits else None


ODD = [
    None, "", "no scheme", "http://", "://x.net/", "HTTP://WWW.Example.NET/en/1", "http://example.net", "http://example.net/en", "http://notexample.net/en/", "http://a.example.com/de/?x://b", "http://x.org/fr/#a",
    "http://x.org#/fr/", "http://org/fr/", "a://b?c=://d/e", "http://ÜBER.Net/ä\nb?c", "http://x.net:80/en/", "http://u@example.net/en/", "x" * 50000 + "://example.com/de/" + "y" * 50000, "http://net/", "http://.net/", "http://example.com/DE/", "\nhttp://q.com/\n?x",
]


def check(rows, got):
    assert sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"])) for r in got) == sorted((str(p), *slow(u)[:2], str(slow(u)[2])) for p, u in rows)
    for r in got:
        assert r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1
        if r["rule"]:
            assert r["verdict"] == urls.RULES[r["rule"]]


def test_whole_table(spark):
    rows = [(r["page_id"], r["url"]) for r in documents(spark, SF, "pages").collect()]
    check(rows, urls.op3_url_filters(spark, SF).collect())


def test_odd_rows(spark):
    rows = [(i, u) for i, u in enumerate(ODD)] + [(None, "http://a.com/"), (5, "http://a.com/")]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "bad", "score", "verdict")})
    check(rows, urls.judge(frame).collect())
    labelled = spark.createDataFrame([("http://a-b.com/1", 1), ("http://c.com", 0), (None, 1), ("http://d.com", None)], "url string, bad int")
    check(rows, urls.judge(frame, labelled).collect())
    check(rows, urls.judge(frame, labelled.limit(0)).collect())
    assert urls.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize("word", ["spam-farm", "casino-win"])
def test_learns_the_shape_of_bad_hosts(spark, word):
    """Trained without one kind of bad host, the trees still block it; clean hosts pass."""
    pages = documents(spark, "/root/testdata/sf0.1", "pages")
    held = F.col("url").contains(word)
    scored = urls.judge(pages, urls.weak_labels(pages.where(~held)), rules={}).join(pages.select("page_id", "url"), "page_id")
    assert scored.where(held & (F.col("verdict") == "allow")).count() == 0
    clean = scored.join(urls.weak_labels(pages).where("not bad").distinct(), "url")
    wrong, n = clean.agg(F.sum((F.col("verdict") == "block").cast("int")), F.count("*")).first()
    assert n > 1000 and wrong / n < 0.01
