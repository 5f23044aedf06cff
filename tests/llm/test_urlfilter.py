"""URL rules against plain code; the model on words it knows."""

import re

from starmart.llm import urlfilter

URLS = [
    "https://www.example.net/en/1?x=/de/", "http://EXAMPLE.NET/EN/1", "http://example.net/en", "http://example.net/en/", "http://notexample.net/en/2",
    "http://a.b.example.com/de/9#/fr/", "http://example.com/den", "http://x.org/fr/", "http://org/fr/3", "http://net", "http://net/", "http://a.net?/en/",
    "ftp://u:p@x.net:80/en/", "no scheme.net/en/", "", None, "://", "http://x.net/a://example.org/fr/", "http://Ünï.org/fr/\nx", "http://x.com/%20 y",
    "x" * 20_000, "http://" + "a." * 5000 + "net/" + "b/" * 5000, "http://www.example.net/en/1",
]


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(h + p, v) for h, p, v in urlfilter.RULES if f".{host}".endswith(f".{h}") and path.startswith(p)]
    return host, path, *max(fits, key=lambda r: len(r[0]), default=(None, None))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "h", "p", "r") for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, host string, path string, rule string")


def test_rules(spark):
    got = urlfilter.judge(pages(spark, [*URLS, *URLS])).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, verdict = plain(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_model(spark):
    urls = ["http://casino-slots.example.info/1", "http://www.cheap-viagra.example.info/x", "http://museum-history.example.info/2",
            "http://blog.garden-recipes.example.info/en/"]
    got = urlfilter.judge(pages(spark, urls)).sort("page_id").collect()
    assert [r.verdict for r in got] == ["block", "block", "allow", "allow"]


def test_own_labels_and_empty_table(spark):
    labels = spark.createDataFrame([("http://a.info/", "allow"), (None, None)], "url string, verdict string")
    assert {r.verdict for r in urlfilter.judge(pages(spark, ["http://q.info/"]), labels).collect()} == {"allow"}
    assert urlfilter.judge(pages(spark, [])).count() == 0


def test_after_an_observation(spark):
    """A session that has observed something holds what cannot be sent to tasks; the model must not carry the session."""
    from starmart.session import counted
    rows, count = counted(spark.range(3))
    rows.collect()
    assert count() == 3
    assert urlfilter.judge(pages(spark, ["http://casino-slots.example.info/1"])).collect()[0].verdict == "block"
