"""URL rules by hand, and trees that must have learned something."""

from loglens.llm import urls

PAGES = [(1, "https://Blog.Example.com/en/1?x=1#a"), (2, "http://www.EXAMPLE.com/en/"), (3, "http://example.com/de/1"), (4, "http://a.net/es/x"),
         (5, "http://a.net/en/x"), (6, "no scheme.com/en/"), (7, None), (8, "http://net/fr/"), (9, "http://org?com/"), (10, "://com#/x"),
         (11, "http://badexample.com/en/"), (12, "http://x.www.example.com/en/?q=http://a.net/es/"), (13, "http://com"), (14, ""), (4, "http://a.net/es/x")]
EXPECTED = {1: ("blog.example.com", "/en/1", "example.com/en/", "block"), 2: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            3: ("example.com", "/de/1", "com/", "allow"), 4: ("a.net", "/es/x", "net/es/", "block"), 5: ("a.net", "/en/x", None, None),
            6: ("", "", None, None), 7: ("", "", None, None), 8: ("net", "/fr/", "net/fr/", "block"), 9: ("org", "", None, None),
            10: ("com", "", None, None), 11: ("badexample.com", "/en/", "com/", "allow"),
            12: ("x.www.example.com", "/en/", "www.example.com/en/", "allow"), 13: ("com", "", None, None), 14: ("", "", None, None)}


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in PAGES], "page_id long, url string, host string, rule string")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        host, path, rule, verdict = EXPECTED[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_trees_judge_what_no_rule_fits(spark):
    pages = [(i, f"http://good{i}.com/a/{i}") for i in range(200)] + [(200 + i, f"http://bad{i}.net/es/{i}?" + "&".join(f"k{j}={j * i}" for j in range(9))) for i in range(200)]
    more = [(1000 + i, f"http://nice{i}.org/a/{i}") for i in range(20)] + [(2000 + i, f"http://evil{i}.org/es/{i}?" + "&".join(f"k{j}={j * i}" for j in range(9))) for i in range(20)]
    rows = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(pages + more, "page_id long, url string")).collect()}
    assert sum(rows[1000 + i] == "allow" for i in range(20)) >= 18
    assert sum(rows[2000 + i] == "block" for i in range(20)) >= 18


def test_one_kind_of_label_or_none(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://a.org/x")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages).collect()} == {1: "allow", 2: "allow"}
    assert urls.judge(pages.where("page_id = 2")).first().verdict == "allow"
    assert urls.judge(pages.limit(0)).collect() == []
