import duckdb
from tessera.llm.oracles import URL_FILTER
from tessera.llm.queries import URL_RULES
from tessera.llm.url_filter import filter_urls

URLS = [None, "", "no scheme/en/", "http://com/", "http://a.b.example.com/en/x?y=/es/#z", "HTTP://WWW.EXAMPLE.COM/en/1",
        "https://www.example.com/en", "http://x.net/fr/é?q", "http://x.net", "http:///en/", "http://example.com:80/en/",
        "http://notexample.com/en/", "ftp://u@example.com/EN/", "http://x.net/es/#/fr/", "a://b://c.com/", "http://.com/",
        "http://example.com/en/\nnew", "http://x.net/es/" + "a/" * 3000]


def judged(spark, rules, urls, **how):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r["page_id"]: r for r in filter_urls(pages, rules, **how).collect()}


def test_equals_sql_on_odd_urls(spark):
    got = judged(spark, URL_RULES, URLS)
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate(URLS)))
    want = con.execute(URL_FILTER).fetchall()
    assert len(got) == len(want) == len(URLS)
    for i, host, path, rule, verdict in want:
        assert tuple(got[i])[2:] == (host, path, rule, verdict)


def test_rules_without_final_slash_and_precedence(spark):
    rules = [("a.org", "/shop", "block"), ("a.org", "", "allow"), ("b.a.org", "/shop", "allow"), ("c.org", "/x/", "allow"),
             ("c.org", "/x/", "block")]
    got = judged(spark, rules, ["x://a.org/shopping", "x://z.a.org/", "x://b.a.org/shop", "x://c.org/x/1", "x://d.org/"],
                 default="block")
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(5)] == [
        ("a.org/shop", "block"), ("a.org", "allow"), ("b.a.org/shop", "allow"), ("c.org/x/", "block"), (None, "block")]


def test_repeated_rows_nulls_and_empty(spark):
    pages = spark.createDataFrame([(1, "x://a.com/"), (1, "x://a.com/"), (None, "x://a.com/"), (None, None)],
                                  "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert filter_urls(pages, rules).count() == 4
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_rules_joined_by_shuffle_give_the_same(spark, monkeypatch):
    from tessera.llm import url_filter

    want = judged(spark, URL_RULES, URLS)
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    assert judged(spark, URL_RULES, URLS) == want


def test_very_long_urls_cost_one_digest_a_shape(spark):
    import time

    rules = [*URL_RULES, ("x.org", "/a/a/a/", "block"), ("x.org", "/a/a/b", "block"), ("z.y", "", "block")]
    deep = "h." * 2000 + "x.org"
    urls = ["http://" + deep + "/" + "a/" * 2000, "http://" + deep + "/a/a/bc", "http://" + deep + "/a/" + "é" * 20000,
            "http://z.y", "http://q.z.y/" + "/" * 2000, "http://" + "." * 3000 + "/en/"]
    began = time.time()
    got = judged(spark, rules, urls)
    assert time.time() - began < 30
    assert [got[i]["rule"] for i in range(6)] == ["x.org/a/a/a/", "x.org/a/a/b", None, "z.y", "z.y", None]


def test_equals_a_plain_version_under_many_rules(spark):
    import random

    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "org", "", "x..org", ".com"]
    rules = sorted({(rng.choice(hosts), "".join(rng.choice(["/", "e", "n"]) for _ in range(rng.randrange(0, 4))), rng.choice(["allow", "block"]))
                    for _ in range(40)})
    urls = [f"s://{rng.choice(hosts + ['c.b.a.com', 'q.org', 'com.'])}{''.join(rng.choice(['/', 'e', 'n']) for _ in range(rng.randrange(0, 6)))}"
            for _ in range(200)]
    for i, r in judged(spark, rules, urls).items():
        h, p = r["host"], r["path"]
        fits = [(len(a) + len(b), v == "block", a + b, v) for a, b, v in rules
                if (h == a or h.endswith("." + a)) and p.startswith(b)]
        assert (r["rule"], r["verdict"]) == (max(fits)[2:] if fits else (None, "allow")), (urls[i], fits)
