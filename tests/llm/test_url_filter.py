import re

from tillcast.llm import url_filter as U

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]
URLS = [
    None,
    "",
    "no scheme",
    "http://Example.COM/en/1?x=1#y",
    "http://www.example.com/en/1",
    "https://blog.WWW.example.com/en/",
    "https://notexample.com/en/1",
    "http://a.net/es/9",
    "http://a.net/fr/9?utm_source=z&b=2&a=1",
    "http://a.net/fr/9/?a=1&b=2&ref=q",
    "https://a.org",
    "https://a.org?x=/y",
    "a://b://c/d",
    "http://a.org/listed/",
    "http://A.ORG/listed#frag",
    "http://a.org/" + "x" * 50_000,
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in RULES
        if (host == r[1].split("/")[0] or host.endswith("." + r[1].split("/")[0]))
        and path.startswith("/" + r[1].split("/", 1)[1])
    ]
    return host, path, max(fits, key=lambda r: len(r[1]), default=(None, None))


def pages(spark, urls):
    rows = [(i, u, "<html>", 7, "x") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, block long, canonical string")


def test_verdicts(spark):
    listed = spark.createDataFrame([("http://a.org/listed",), ("http://a.net/fr/9?a=1&b=2",), (None,), ("junk",)], "url string")
    got = U.judge(pages(spark, URLS + URLS[:4]), listed, RULES).collect()
    assert len(got) == len(URLS) + 4
    for r in got:
        url = (URLS + URLS[:4])[r["page_id"]]
        host, path, (action, rule) = brute(url)
        hit = bool(url) and (url.lower().startswith("http://a.org/listed") or url.startswith("http://a.net/fr/9"))
        verdict = action or ("block" if hit else "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["listed"]) == (host, path, rule, verdict, hit)


def test_many_listed(spark):
    """No listed URL is lost in the filter, and no other one gets through."""
    urls = [f"http://h{i % 50}.org/p/{i}" for i in range(6000)]
    listed = spark.createDataFrame([(u,) for u in urls[::3]], "url string")
    got = {r["page_id"]: r["listed"] for r in U.judge(pages(spark, urls), listed, RULES).collect()}
    assert got == {i: i % 3 == 0 for i in range(6000)}


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "url string")
    assert all(not r["listed"] for r in U.judge(pages(spark, URLS), nothing, RULES).collect())
    assert U.judge(pages(spark, []), nothing, RULES).count() == 0


def test_only_built_in_functions(spark):
    plan = U.judge(pages(spark, URLS), pages(spark, URLS), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
