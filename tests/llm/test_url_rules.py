import itertools
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from regiocast.llm import url_rules
from regiocast.llm.queries import URL_RULES, op11_url_filter

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def parts_of(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def tokens_of(url):
    url = re.sub("[0-9]+", "0", lower(url or ""))
    if "://" not in url:
        return set()
    scheme, rest = url.split("://", 1)
    host, path = parts_of(url)
    asked = re.match(r"[^?#]*\?([^#]*)", rest)
    out = {f"s:{scheme}"} if re.fullmatch("[^:/?#]+", scheme) else set()
    out |= {f"h:{x}" for x in re.split(r"[.\-_:@]", host) if x} | {f"p:{x}" for x in re.split(r"[/.\-_~+%=&;,]", path) if x}
    out |= {f"q:{x.split('=')[0]}" for x in (asked.group(1).split("&") if asked else []) if x}
    return out | ({"f:#"} if "#" in rest else set())


def listed(url):
    host, path = parts_of(url)
    fits = [(len(h), len(p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def mine(labelled, min_support=0.01, min_count=10, min_confidence=0.95):
    """{tokens: (verdict, confidence, support)} by counting every combination of up to four tokens."""
    n = len(labelled)
    if n < min_count:
        return {}
    baskets = [(tokens_of(u), v) for u, v in sorted(labelled)]
    places = defaultdict(set)
    for i, (ts, _) in enumerate(baskets):
        for t in ts:
            places[t].add(i)
    names = defaultdict(list)
    for t, at in places.items():
        names[frozenset(at)].append(t)
    kept = {min(ts) for ts in names.values()}
    least = max(min_support * n, min_count)
    seen, both = Counter(), Counter()
    for ts, v in baskets:
        ts = sorted(t for t in ts & kept if len(places[t]) >= least)
        for k in range(5):
            for c in itertools.combinations(ts, k):
                seen[c] += 1
                both[c, v] += 1
    sure = {(c, v): m / seen[c] for (c, v), m in both.items() if m >= least}
    rules = {}
    for (c, v), s in sure.items():
        below = [sure.get((d, v), 0) for k in range(len(c)) for d in itertools.combinations(c, k)]
        if c and s >= min_confidence and max(below) < s:
            rules[c, v] = (s, both[c, v])
    return rules


def expected(urls):
    labelled = {(u or "", listed(u)[1]) for u in urls if listed(u)[1]}
    rules = mine(labelled)
    out = {}
    for u in urls:
        rule, verdict = listed(u)
        mined = None
        if not rule:
            ts = tokens_of(u)
            fits = [(s, m, len(c), " ".join(c), v) for (c, v), (s, m) in rules.items() if set(c) <= ts]
            mined, verdict = max(fits)[3:] if fits else (None, "allow")
        out[u] = (*parts_of(u), rule, verdict, mined)
    return out


ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "https://com", "https://com/", "http://a.net/es/?q=://b", "x://notexample.com/en/1"]
ODD += ["http://example.com:80/en/", "http://u@example.com/en/", "://example.com/en/", "http://ex\nample.com/en/\n?a=1#b#c", "http://É.example.com/EN/", "http://net/fr/" + "a/" * 20000]


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_query_against_brute_force(spark, folder):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    want = expected([u for _, u in rows])
    got = op11_url_filter(spark, folder).collect()
    assert sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict, str(r.mined)) for r in got) == sorted(
        (i, h, p, str(r), v, str(m)) for i, u in rows for h, p, r, v, m in [want[u]]
    )


def test_odd_urls_copies_and_clashing_columns(spark):
    many = [f"https://{s}.example.{t}/{x}/{i}{e}" for i, (s, t, x, e) in enumerate(itertools.product(["www", "m", "a-b"], ["com", "net", "org"], ["en", "fr", "es"], [".html", "?p=1", "#t", "/"]))]
    urls = ODD + many + many[:1] * 300 + ODD[:3]
    df = spark.createDataFrame([(i // 2 or None, u, "old", 1) for i, u in enumerate(urls)], "page_id long, url string, verdict string, extra int")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = url_rules.judge(df, rules)
    assert set(out.columns) == {"page_id", "url", "extra", "host", "path", "rule", "mined", "verdict"}
    want = expected(urls)
    got = out.collect()
    assert sorted((str(r.url), r.host, r.path, str(r.rule), r.verdict, str(r.mined)) for r in got) == sorted((str(u), *map(str, want[u])) for u in urls)
    assert any(r.mined and r.verdict == "block" for r in got)
    assert url_rules.judge(df.limit(0), rules).collect() == []


def test_tokens(spark):
    urls = ODD + ["ftp://h-1.b_c/x.y~z+1?a=1&b&&c=d=e#top"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = df.select("url", url_rules.tokens(F.col("url")).alias("t")).collect()
    for r in got:
        assert sorted(r.t) == sorted(tokens_of(r.url)), r.url


def test_support_and_confidence_cover_all_labels_beyond_the_fit(spark):
    labelled = [(f"http://bad.example/{i}x{i}", "block") for i in range(400)] + [(f"http://good.example/{'ok' if i % 3 else 'so'}/{i}x", "allow") for i in range(400)]
    labelled += [("http://bad.example/once/but/fine", "allow")]
    df = spark.createDataFrame(labelled * 2, "url string, verdict string")
    got = {(tuple(r.tokens), r.verdict): (r.support, r.confidence) for r in url_rules.mine(df, mined_max=300).collect()}
    assert got[("h:bad",), "block"] == (400, 400 / 401)
    assert got[("h:good",), "allow"] == (400, 1.0)


def test_a_token_that_adds_nothing_is_pruned(spark):
    rows = [(f"http://x.org/spam/{c}", "block") for c in "abcdefghijklmnop"] + [(f"http://x.org/news/{c}", "allow") for c in "abcdefghijklmnop"]
    got = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string")).collect()
    assert sorted((tuple(r.tokens), r.verdict) for r in got) == [(("p:news",), "allow"), (("p:spam",), "block")]
