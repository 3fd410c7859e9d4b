import pytest
from helpers import clash

from shelfwatch.llm import url_filter as U

URLS = [
    None, "", "no scheme.com/", "http://example.com", "http://example.com/", "https://EXAMPLE.com/en/1", "http://www.example.com/en/x?y",
    "http://a.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://x.net/EN/fr/", "http://net/fr",
    "http://x.net#/fr/", "http://x.org/login/?a", "http://example.com:80/en/", "http://é.com/en/", "http://a b.net/fr/z", "://net/es/a", "a://b://net/es/",
    "http://x.org/" + "a/" * 50_000, "http://m.example.com/login/", "http://x.org/Search?q=1",
]


def brute(url):
    host, path = U.host_and_path(url)
    fits = [r for r in U.BASE if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    return host, path, None, "block" if any(p.pattern in low for p in U.PATTERNS) else "allow"


def test_against_every_rule_on_every_url(spark):
    pages = clash(spark.createDataFrame(list(enumerate(URLS + URLS[:3])), "page_id long, url string"), "rule", "host", "t")
    out = U.filter_urls(pages).collect()
    assert len(out) == len(URLS) + 3
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"]), r["url"]
    assert U.filter_urls(pages.limit(0)).count() == 0


def test_blocks_of_rules_give_the_same(spark):
    rules = [*U.BASE, *U.PATTERNS, U.Rule("allow", pattern="*.example.com/*/x"), *[U.Rule("block", f"h{i}.net", "/es/") for i in range(40)]]
    urls = spark.createDataFrame([(u,) for u in [*URLS, "http://h7.net/es/1", "http://q.example.com/en/x"]], "url string")
    one = [r["judged"] for r in U.judge(urls, rules).collect()]
    assert one == [r["judged"] for r in U.judge(urls, rules, block=7).collect()]
    assert one[-2]["name"] == "h7.net/es/"


def test_rules_are_filed_under_their_rarest_token():
    rules = [U.Rule("block", "a.com", "/x/"), U.Rule("allow", "com", "/"), U.Rule("block", pattern="*")]
    by_token, rest = U.index(rules, {"com": 9, "a": 5, "x": 7})
    assert by_token == {"a": [0], "com": [1]} and rest == [2]


@pytest.mark.parametrize("rule", [*U.BASE, *U.PATTERNS, U.Rule("block", pattern="/ab*cd/ef-*.gh?")])
def test_tokens_are_whole_in_every_fitting_url(rule):
    url = f"http://w.{rule.host or 'q'}{rule.path}zz" if rule.host else "http://q/qq" + rule.pattern.replace("*", "zz") + "zz"
    assert rule.tokens() <= set(U._TOKEN.findall(url.lower()))
