"""Rules by literal index and by join give what trying every rule gives."""

import re

import pytest

from riskloom.llm import urlfilter
from riskloom.llm.queries import SITE_RULES, _url_rules

URLS = [
    None,
    "",
    "no scheme/org/",
    "http://org/",
    "http://a.org/x",
    "http://borg/x",
    "https://www.Example.ORG/es/1?x#y",
    "https://example.org/en/12",
    "https://example.org/en/2",
    "https://example.org",
    "https://example.org?x=/es/",
    "https://example.org#a://b",
    "x://shop.com/fr/",
    "x://shop.com/de/1",
    "x://shop.com/DE/1",
    "http://cheap-pills.example.com/en/1",
    "http://spam-farm.example.org/es/",
    "http://spam-farm.example.net/a",
    "http://u:p@example.org:80/es/",
    "http://casino.net/",
    "http://x.net/" + "a/" * 20_000 + "login",
    "http://ünï.net/login",
    "http://ünï.net/login",
]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    best = None
    for rule, verdict in SITE_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    if best:
        return host, path, best[0], best[1]
    fits = [r for r in _url_rules() if not r.site and re.search(r.pattern, host + path)]
    return host, path, None, "block" if fits else "allow"


@pytest.mark.parametrize("literal_rules", [urlfilter.LITERAL_RULES, 0])
def test_verdicts(spark, literal_rules):
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    out = urlfilter.judge_urls(df, _url_rules(), literal_rules=literal_rules)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "pattern", "verdict"]
    got = {r["page_id"]: r for r in out.collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(url), url
    assert urlfilter.judge_urls(df.limit(0), _url_rules(), literal_rules=literal_rules).collect() == []


def test_rarest_token_is_the_index(spark):
    df = spark.createDataFrame([("example.org/a",), ("example.org/b",), ("shop.org/a",)], "_subject string")
    rule = urlfilter.site_rule("example.org/b/", "block")
    assert urlfilter.index_rules(df, [rule])[0][0] == "b"
    assert urlfilter.site_rule("example.org/en/1", "block").tokens == ("example", "org", "en")


def test_rules_without_tokens_or_none_at_all(spark):
    df = spark.createDataFrame([(1, "http://a.net/x1")], "page_id long, url string")
    always = urlfilter.pattern_rule("digits", "block", "[0-9]$")
    for limit in (0, 10):
        assert urlfilter.judge_urls(df, [always], literal_rules=limit).first()["pattern"] == "digits"
    assert urlfilter.judge_urls(df, []).first()["verdict"] == "allow"
