"""URL filter against a plain reading of the rules."""
from tramline.llm import url_filter

URLS = [None, "", "no scheme/path", "http://a.net/", "http://a.NET/x", "http://anet/", "http://net/", "http://net",
        "https://example.net/en/1", "https://x.example.net/en/", "https://example.net/enx", "http://badexample.net/en/",
        "http://EXAMPLE.com/de/", "http://sub.example.com/de/x?y", "http://example.com/De/", "http://a.org/fr/1",
        "http://a.org?x=/fr/", "http://a.org#/fr/", "http://a.org/x/fr/", "://b.net/", "http://c.net/http://d.org/fr/",
        "http:///de/", "http://a..net/", "http://.net/", "http://net./", "http://a.net/\nb", "http://É.example.net/en/É",
        "http://" + "a." * 300 + "net/" + "x/" * 300, "http://a.net/en/", "http://example.net//en/"]


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), len(h), a == "block", h + p, a) for a, h, p in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_awkward_urls(spark):
    rows = [(k, u, "x") for k, u in enumerate(URLS)] + [(3, URLS[3], "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.judge(pages, url_filter.rule_table(spark, url_filter.RULES)).collect()
    want = [(k, *judge(u, url_filter.RULES)) for k, u, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rules_that_do_not_end_at_a_folder(spark):
    rules = [("block", "a.b", "/x/y"), ("allow", "b", "/x/yz"), ("block", "b", ""), ("allow", "a.b", "/x/")]
    urls = ["http://a.b/x/y", "http://a.b/x/yz/1", "http://c.a.b/x/", "http://b/x/yz", "http://b", "http://q.b/x/y"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()}
    assert got == {k: judge(u, rules) for k, u in enumerate(urls)}


def test_only_dataframe_functions(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = url_filter.judge(pages, url_filter.rule_table(spark, url_filter.RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = url_filter.rule_table(spark, url_filter.RULES)
    assert url_filter.judge(none, rules).count() == 0
    page = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(page, rules.limit(0)).collect()] == ["allow"]


def test_long_urls_expand_to_the_depth_of_the_rules(spark):
    url = "http://" + "a." * 5000 + "example.net/en/" + "x/" * 50_000
    pages = spark.createDataFrame([(1, url), (2, "http://net" + "/" * 30_000)], "page_id long, url string")
    rules = url_filter.rule_table(spark, url_filter.RULES)
    host, path = url_filter.host_and_path(url_filter.F.col("url"))
    assert url_filter.expand(pages.select(host.alias("host"), path.alias("path")), rules).count() <= 2 * 3 * 4
    assert {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()} == {
        1: ("example.net/en/", "allow"), 2: ("net/", "block")}
