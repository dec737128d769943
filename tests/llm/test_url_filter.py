import duckdb
import pandas as pd

from windlass.llm import url_filter as uf

URLS = ["http://net/", "http://a.net/x", "https://EXAMPLE.net/en/1", "https://b.example.net/en/", "https://b.example.net/En/",
        "http://example.net", "http://example.net?x=/en/", "http://example.com/de/1#f", "http://xexample.com/de/", "ftp://org/fr/?q",
        "http://a.org/fr", "http://a.org/fr/z/", None, "", "no scheme", "://net/", "http://net:80/", "http://u@net/", "http://a..net/",
        "http://net./x", "http://.net/x", "a://b://c.net/", "http://notnet/", "http://x-net/", "http://a/net/", "http://é.net/ü?"] * 2


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((-len(rule), rule, verdict))
    best = min(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, stack string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict)
            for r in uf.judge_urls(pages, uf.rule_table(spark, rules)).collect()}


def test_production_rules_match_brute_force_and_sql(spark):
    want = {i: brute(u, uf.RULES) for i, u in enumerate(URLS)}
    assert judged(spark, URLS, uf.RULES) == want
    pages = pd.DataFrame({"page_id": range(len(URLS)), "url": URLS})  # noqa: F841
    con = duckdb.connect()
    con.register("pages", pages)
    got = {r[0]: r[1:] for r in con.execute(uf.ORACLE_SQL).fetchall()}
    assert got == want


def test_deep_nesting_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(uf, "HOSTS_PER_RANGE", 3)
    rules = [("block", "com/"), ("allow", "a.com/"), ("block", "b.a.com/"), ("allow", "c.b.a.com/x/"), ("block", "c.b.a.com/x/y/"),
             ("allow", "z.com/"), ("block", "a-b.com/"), ("block", "org/p/"), ("allow", "org/p/q")]
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "d.c.b.a.com", "aa.com", "a-b.com", "x.a-b.com", "z.com", "y.z.com", "zz.com",
             "b.com", "org", "k.org", "com.org", "abcom"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/x/", "/x/y/1", "/p/", "/p/q")]
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rows_or_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge_urls(empty, uf.rule_table(spark)).count() == 0
    none = spark.createDataFrame([], "verdict string, rule string")
    one = spark.createDataFrame([(None, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in uf.judge_urls(one, none).collect()] == [(None, "a.net", "/", None, "allow")]


def test_plan_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = uf.judge_urls(pages, uf.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
