import re
from collections import Counter

import pytest

from quotewright.llm import urls
from quotewright.llm.urls import Rule

URLS = [
    None, "", "no scheme", "http://", "https://a.example.org/es/1", "https://example.org/en/1234", "https://m.example.org/en/2",
    "https://notexample.org/es/", "http://X.COM/de/?q", "http://x.com/fr", "http://x.com/fr/a#b", "http://x.com/DE/", "http://com/de/1",
    "http://org/x", "http://org", "ftp://q.example.net?x/org/", "http://a://b.org/c", "http://shop.cheap-pills.example.net/x", "http://casino.net",
    "http://q.net/user/login?x", "http://q.net/loginpage", "http://q.net/cart", "http://éa.org/é", "http://a.org:80/x", "http://u@b.org/x\ny",
    "http://x.com/" + "a/" * 20_000 + "login", "http://q.net/login\u212a", "http://q.net/cart\u0130", "http://\u212ax.com/fr/",
]


def by_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fitting = []
    for name, verdict in (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")):
        own, _, start = name.partition("/")
        if (host == own or host.endswith(f".{own}")) and path.startswith(f"/{start}"):
            fitting.append((len(name), name, verdict))
    return (host, path, *(max(fitting)[1:] if fitting else (None, None)))


@pytest.fixture
def pages(spark):
    rows = [(i if i != 5 else None, url, "clash", "clash") for i, url in enumerate(URLS)]
    return spark.createDataFrame([*rows, rows[4], rows[4]], "page_id long, url string, host string, rule string")


def test_judged_by_rule(spark, pages):
    rows = urls.judge_urls(pages).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in rows) == Counter(
        (row["page_id"], *by_rule(row["url"])[:3]) for row in pages.collect()
    )
    for row in rows:
        verdict = {"org/": "allow", "com/fr/": "allow"}.get(row["rule"], "block" if row["rule"] else None)
        assert row["verdict"] == verdict or verdict is None
    advised = {row["page_id"] for row in rows if row["rule"] is None and row["verdict"] == "block"}
    assert advised == {17, 18, 19, 21, 25, 26, 27}


def test_index_gives_what_all_rules_give(spark, pages):
    rules = urls.RULES + urls.ADVICE + (Rule("any", r".*ex.*le", (), "block", False), Rule("two", r"[^/]*example\.(org|net)", ("example",), "block"))
    plain = tuple(Rule(r.name, r.pattern, (), r.verdict, r.listed) for r in rules)
    names = ("page_id", "host", "path", "rule", "verdict")
    by_index = Counter(map(tuple, urls.judge_urls(pages, rules=rules).select(*names).collect()))
    assert by_index == Counter(map(tuple, urls.judge_urls(pages, rules=plain).select(*names).collect()))


def test_rarest_token_files_a_rule():
    index = urls.rule_index(urls.RULES, {"org": 90, "example": 100, "es": 3, "en": 500, "com": 50, "fr": 70})
    assert [rule.name for rule in index["es"]] == ["example.org/es/"]
    assert [rule.name for rule in index["org"]] == ["org/", "example.org/en/1"]
    assert [rule.name for rule in index["de"]] == ["com/de/"]


def test_no_rows(spark, pages):
    assert urls.judge_urls(pages.limit(0)).count() == 0
    assert {row["verdict"] for row in urls.judge_urls(pages, rules=()).collect()} == {"allow"}


def lines_of(count):
    """Filter lines of every sign over common and rare words."""
    hosts = ("ads.example.org", "track.example.net", "example.com", "media.example.org")
    lines = []
    for i in range(count):
        host, word = hosts[i % 4], f"w{i}"
        lines += [f"||{host}/{word}^", f"/{word}/banner*.gif|", f"||{host}^*/{word}*x^", f"*-{word}-", f"@@||{host}/{word}/ok|"]
    return lines


def places_of(count):
    out = []
    for i in range(0, count, 7):
        for host in ("ads.example.org", "a.media.example.org", "notexample.com", "example.com"):
            out += [f"{host}/w{i}", f"{host}/W{i}/ok", f"{host}/w{i}/banner12.gif", f"{host}/a/w{i}yx", f"{host}/q-w{i}-r/w{i}_"]
    return out


def test_filter_lines():
    def fits(line, place):
        return bool(re.compile(urls.filter_rule(line).pattern, re.DOTALL).match(place))

    assert fits("||example.org^", "example.org/") and fits("||example.org^", "a.example.org/x")
    assert not fits("||example.org^", "notexample.org/") and not fits("||example.org^", "example.org.net/")
    assert fits("/ad*.gif|", "x.net/a/AD_1.gif") and not fits("/ad*.gif|", "x.net/ad.gif/y")
    assert fits("/k^", "x.net/K") and not fits("/k^", "x.net/\u212a")
    assert urls.filter_rule("||ads.example.org/b*/c^").tokens == ("ads", "example", "org", "c")
    assert urls.filter_rule("/ad*.gif|").tokens == ("gif",)
    assert urls.filter_rule("word").tokens == ()
    assert urls.filter_rule("@@||example.org^").verdict == "allow"


def test_a_table_of_rules(spark):
    lines = [(line,) for line in [*lines_of(80), "", "! a comment", None, "  ||example.com/w2^ "]]
    rules = urls.read_rules(spark.createDataFrame(lines, "line string"))
    assert len(rules) == 400
    places = places_of(80)
    pages = spark.createDataFrame([(i, f"http://{place}") for i, place in enumerate(places)], "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages, rules=rules).collect()}
    for i, place in enumerate(places):
        fitting = [rule for rule in rules if re.compile(rule.pattern, re.DOTALL).match(place)]
        verdict = "allow" if not fitting or any(r.exception for r in fitting) else "block"
        assert found[i] == verdict, place
    assert set(found.values()) == {"allow", "block"}
    with pytest.raises(ValueError):
        urls.read_rules(spark.createDataFrame(lines, "line string"), most=5)


def test_the_rarest_token_runs_fewer_rules(spark):
    rules = tuple(map(urls.filter_rule, lines_of(80)))
    places = places_of(80)
    frame = spark.createDataFrame([tuple(place.split("/", 1)) for place in places], "host string, path string")
    frame = frame.selectExpr("host", "concat('/', path) AS path")
    by_rarest = urls.rule_index(rules, urls.token_counts(frame, rules))
    by_first = {}
    for rule in rules:
        by_first.setdefault(rule.tokens[0] if rule.tokens else "", []).append(rule)
    runs = [sum(len(urls.candidate_rules(index, place)) for place in places) for index in (by_rarest, by_first)]
    assert runs[0] * 3 < runs[1]
