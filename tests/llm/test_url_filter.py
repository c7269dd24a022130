"""Rules against a plain reading, and what the regression learns."""

from reelhouse.llm import queries, url_filter

RULES = queries.URL_RULES
URLS = [
    None, "", "abc", "http://", "HTTP://A.Net", "http://a.net/", "x://y://z.net/a?b", "http://É.NET/en",
    "http://EXAMPLE.net/en/x#q", "http://net/", "http://xnet/", "http://a.org/fr/?x", "http://a.org?/fr/",
    "http://example.com/de/\n/x", "http://a.net\n/x", "http://Éx.net/" + "a" * 100_000, "http://example.com/de/",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    i = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    j = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:i])
    fits = [
        r for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and rest[i:j].startswith(r.path)
    ]
    return host, rest[i:j], max(fits, key=lambda r: len(r.name)) if fits else None


def test_rules_and_parts(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "'k' AS rule")
    model = url_filter.fit(url_filter.rule_labelled(df, RULES))
    rows = {r["page_id"]: r for r in url_filter.judge(df, RULES, model).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule = plain(url)
        assert (rows[i]["host"], rows[i]["path"]) == (host, path)
        assert rows[i]["rule"] == (rule.name if rule else None)
        assert rows[i]["verdict"] == rule.verdict if rule else rows[i]["verdict"] in ("allow", "block")


def test_the_regression_learns_and_reruns_agree():
    hosts = [f"s{i}.bad{i % 3}.com" for i in range(60)] + [f"s{i}.fine{i % 3}.org" for i in range(60)]
    paths = ["/a/b"] * 120
    model = url_filter.train(hosts, paths, [1] * 60 + [0] * 60)
    assert (model.margins(["new.bad1.com", "x.fine2.org"], ["/q", "/q"]) > 0).tolist() == [True, False]
    again = url_filter.train(hosts, paths, [1] * 60 + [0] * 60)
    assert (model.weights == again.weights).all() and model.bias == again.bias


def test_without_labels_everything_is_allowed(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    model = url_filter.fit(url_filter.rule_labelled(df, RULES))
    assert url_filter.judge(df, RULES, model).first()["verdict"] == "allow"
    assert url_filter.judge(df.limit(0), RULES, model).count() == 0


def test_query_covers_all_pages(spark):
    sf = "/root/testdata/sf0.001"
    made = queries.op2(spark, sf)
    assert made.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert made.count() == spark.read.parquet(f"{sf}/pages.parquet").count()
