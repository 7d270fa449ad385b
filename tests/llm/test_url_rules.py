import re

from brute import rows

from terroir.llm import queries as Q
from terroir.llm import url_rules as U

SCHEMA = "page_id long, url string, token string, rule string, rows string"


def frame(spark, data):
    return spark.createDataFrame([(i, u, "t", "x", "y") for i, u in data], SCHEMA)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def judge(url, rules=Q.URL_RULES):
    host, path = split(url)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    bad = any(w in re.split(r"[.\-]", host) for w in U.BLOCKED_HOST_WORDS)
    return host, path, None, "block" if bad else "allow"


URLS = ["http://example.org/es/1", "http://a.example.org/en/1x", "https://EXAMPLE.org/en/2", "http://notexample.org/es/", "http://x.com/fr/",
        "http://x.com/fr", "http://x.com/de/?q#f", "http://com/de/a", "http://xcom/de/", "http://org", "http://org/", "http://a.org?x=/",
        "http://adult-x.net/", "http://x.adult/", "http://adults.net", "http://free-bets.example.com/de/1", "ftp://É.org/p", "no scheme", "",
        None, "://", "http://", "a://b://c.com/fr/", "http://x.com:80/de/", "http://example.org/en/1", "http://x.net/\n?a", "HTTP://A_B.pills.org",
        "http://ex.com/" + "long/" * 20_000, "http://[::1]/de/", "http://x.org/%20", "http://.org/", "http://a..com/de/", "http://user@x.com/de/"]


def check(spark, urls, rules=Q.URL_RULES):
    data = [(k % 9 if k % 5 else None, u) for k, u in enumerate(urls)]
    got = rows(U.judge_urls(frame(spark, data), [U.host_path_rule(*r) for r in rules]), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted(((i, *judge(u, rules)) for i, u in data), key=repr)


def test_edges_and_repeated_rows(spark):
    check(spark, URLS + URLS[:9])


def test_rules_without_tokens_and_ties(spark):
    check(spark, URLS, [("", "/", "block"), ("com", "/", "allow")])
    check(spark, URLS, [("x.com", "/d", "allow"), ("com", "/de/", "block"), ("com", "/d", "allow")])
    check(spark, URLS, [])


def test_empty_table(spark):
    assert U.judge_urls(frame(spark, []), [U.host_path_rule("org", "/", "allow")]).count() == 0


def test_index_takes_the_rarest_token(spark):
    urls = frame(spark, [(k, f"http://s{k % 3}.common.org/a") for k in range(30)] + [(99, "http://rare.org/a")])
    host, path = U.split_url(urls["url"])
    tokens = urls.select(host.alias("host"), path.alias("path")).select(
        U.F.explode(U.url_tokens(U.F.col("host"), U.F.col("path"))).alias("token"))
    filed, free = U.rule_index(tokens, [U.host_path_rule("rare.org", "/a/", "block"), U.host_path_rule("", "/", "allow")])
    assert [(t, r.text) for t, r in filed] == [("h:rare", "rare.org/a/")]
    assert [r.text for r in free] == ["/"]


def test_few_rules_do_not_shuffle_the_tokens(spark):
    urls = frame(spark, [(k, f"http://s{k}.net/a") for k in range(30)])
    plan = U.judge_urls(urls, [U.host_path_rule("s1.net", "/a", "block")])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
