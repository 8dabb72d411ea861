import re

import pytest

from ontime.llm import url_filters as u
from ontime.llm.queries import HOST_RULES, SPAM_PATTERNS

URLS = [
    "http://example.com/en/1", "https://www.example.com/en/x?q#f", "https://a.www.example.com/en/", "http://sub.EXAMPLE.com/en/y",
    "http://example.com/EN/1", "http://badexample.com/en/1", "http://net/es/", "http://x.net/es/a", "http://x.net/es", "http://xnet/es/",
    "http://x.net/fr/?a://b/c", "http://casino-win.example.org/de/1", "http://free-bets.example.com/de/2", "http://x.org/casino-win.html",
    "http://x.com", "http://x.com?y=/", "http://x.com/", "no scheme casino-win.x", "://net/es/", "", None, "http://x.com:80/en/",
    "mailto:a@b", "http:///net/es/", "http://ex.net/en/es/", "http://b.net/\nes/", "http://example.com/en/1",
]


def reference(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in HOST_RULES:
        rh, slash, rp = r.rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith(slash + rp):
            if best is None or len(r.rule) > len(best.rule):
                best = r
    spam = any(p.pattern.strip("*") in (url or "").lower() for p in SPAM_PATTERNS)
    return host, path, best and best.rule, best.verdict if best else "block" if spam else "allow"


def test_rules_and_patterns(spark):
    df = spark.createDataFrame([(i, x, "mine", i) for i, x in enumerate(URLS)], "page_id bigint, url string, host string, _url bigint")
    out = u.judge_urls(df, HOST_RULES, SPAM_PATTERNS)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert [got[i] for i in range(len(URLS))] == [reference(x) for x in URLS]
    assert sorted(out.columns) == ["_url", "host", "page_id", "path", "pattern", "rule", "url", "verdict"]
    assert u.judge_urls(df.limit(0), HOST_RULES, SPAM_PATTERNS).count() == 0
    assert {r.verdict for r in u.judge_urls(df, []).collect()} == {"allow"}


def test_plan_is_native_and_without_shuffle(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    plan = u.judge_urls(df, HOST_RULES, SPAM_PATTERNS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_literal_tokens_are_whole():
    assert u.literal_tokens(u.HostRule("block", "net/es/")) == {"net", "es"}
    assert u.literal_tokens(u.HostRule("block", "net/es")) == {"net"}  # also fits net/estate
    assert u.literal_tokens(u.PatternRule("*casino-win.*")) == {"win"}
    assert u.literal_tokens(u.PatternRule("casino")) == set()


def test_rules_are_filed_under_their_rarest_token(spark):
    df = spark.createDataFrame([(i, "http://a.net/x/") for i in range(5)] + [(9, "http://b.net/es/")], "page_id bigint, url string")
    counts = u.token_counts(df, "url", {"net", "es", "absent"})
    assert counts == {"net": 6, "es": 1}
    entry = [e for b in u._index([u.HostRule("block", "net/es/")], counts) for e in b]
    assert [e["token"] for e in entry] == ["es"]


def test_separator_and_anchors(spark):
    urls = ["http://x.org/ad?x", "http://x.org/ad", "http://x.org/adder", "http://x.org/a/ad/z"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in u.judge_urls(df, [], [u.PatternRule("|http://x.org/ad^")]).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow"}
    with pytest.raises(ValueError):
        u.judge_urls(df, [u.HostRule("block", "net")])


def test_thousands_of_rules(spark):
    """Rules that share their frequent tokens: each URL gets what trying every rule on it gives."""
    hosts = [u.HostRule(("allow", "block")[i % 2], f"h{i}.example.com/{('', 'en/', 'p%d/' % (i % 5))[i % 3]}") for i in range(1500)]
    patterns = [u.PatternRule(p) for i in range(700) for p in (f"*-track{i}.*", f"|http://ad{i}^")]
    urls = [x for i in range(0, 1600, 9) for x in (
        f"http://a.h{i}.example.com/en/x", f"https://h{i}.example.com/p{i % 5}/", f"http://ad{i}/en", f"http://ad{i}x/en",
        f"http://b.org/my-track{i}.js?q", f"http://h{i}.example.com.org/")]
    got = {r.url: (r.rule, r.verdict, r.pattern) for r in
           u.judge_urls(spark.createDataFrame([(x,) for x in urls], "url string"), hosts, patterns).collect()}
    tried = [(p.pattern, re.compile(u._pattern_regex(p.pattern))) for p in patterns]
    for x in urls:
        host, path = re.match(r".*?://([^/?#]*)([^?#]*)", x).groups()
        fit = [r for r in hosts if path.startswith("/" + r.rule.partition("/")[2])
               and (host == r.rule.partition("/")[0] or host.endswith("." + r.rule.partition("/")[0]))]
        rule = max(fit, key=lambda r: len(r.rule), default=None)
        pattern = min((p for p, expr in tried if expr.search(x)), default=None)
        verdict = rule.verdict if rule else "block" if pattern else "allow"
        assert got[x] == (rule and rule.rule, verdict, pattern), x
    assert {v for _, v, _ in got.values()} == {"allow", "block"} and any(p for _, _, p in got.values())
