"""URL rules against each rule tried on each URL."""

from __future__ import annotations

import re

from waferscope.llm import urls
from waferscope.llm.registry import URL_RULES

NAMED = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
ODD = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "https://a.www.example.com/en/", "https://example.com/en", "https://example.com",
    "https://example.com/EN/x", "https://notexample.com/en/", "http://x.net/es/?q=1", "http://net/fr/a#b", "http://x.net?/es/", "http://x.org/casino-win/",
    "http://casinos.org/", "http://x.org/?u=http://a.com/", "//x.com/", "ftp://example.com:80/en/", "http://é.com/ü", "http://x.net/fr/" + "y" * 200_000,
    "http://x.net/es/\nfoo", "a://b://c.com/en/", "http://www.example.com/en/?casino", "http://x.org/xxx", "http://x.org/xxxx", "http://com/",
]


def brute(url: str | None) -> tuple:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group() if rest[len(host) :][:1] not in ("?", "#") else ""
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [
        (len(text), text, verdict)
        for verdict, text in NAMED
        if (host == text.split("/")[0] or host.endswith("." + text.split("/")[0])) and path.startswith("/" + text.split("/", 1)[1])
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    words = re.split(r"[\W_]+", rest.lower())
    return host, path, None, "block" if set(words) & set(urls.BLOCKED_WORDS) else "allow"


def test_every_rule_on_every_url(spark):
    rows = [(i, u, "h", "r", 1) for i, u in enumerate(ODD)] + [(3, ODD[4], "h", "r", 1), (None, ODD[9], None, None, None), (3, ODD[4], "h", "r", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, token int")
    found = [tuple(r) for r in urls.judge(pages, [*URL_RULES, *urls.DEFAULT_RULES]).collect()]
    assert sorted(found, key=str) == sorted([(i, *brute(u)) for i, u, *_ in rows], key=str)
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def test_rules_are_filed_under_whole_tokens():
    assert urls.host_rule("block", "example.com/en/").tokens == ("com", "en", "example")
    assert urls.host_rule("block", "example.com/en/fo").tokens == ("com", "en", "example")
    assert urls.host_rule("allow", "com/").tokens == ("com",)
