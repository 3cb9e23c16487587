import random
import re

from tickforge.llm.urlrules import judge, mine, tokens_of

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("block", "example.net", "/de/8"), ("allow", "net", "/de/"), ("block", "org", "/es/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def stated(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "://x", "http://COM/en/", "https://a.EXAMPLE.com/en/75?q=1#f", "http://example.com/en/6", "http://notexample.net/de/8", "http://b.example.net/de/8/x", "http://x.org/es/", "http://x.org?/es/", "http://x.org#/es/", "http://É.org/es/1", "a://b://c/d", "http://com:80/en/", "http://x.com/en", "http://y.com/en/\n2", "http://example.com/en/7" + "9" * 50_000]


def test_stated_rules(spark):
    rows = [(i, u, "z", "z") for i, u in enumerate(URLS)] + [(None, URLS[5], "z", "z"), (5, URLS[5], "z", "z")]
    got = judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        u = URLS[5] if r.page_id is None else URLS[r.page_id]
        host, path = parts(u)
        rule, verdict = stated(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), u


def labelled(n=2000):
    r = random.Random(2)
    rows = []
    for i in range(n):
        bad_host, bad_query = r.random() < 0.1, r.random() < 0.5
        host = "spam-farm.test" if bad_host else f"site{r.randrange(40)}.test"
        rows.append((i, f"http://www.{host}/a/{i}{'?aff=1' if bad_query else ''}", (bad_host and bad_query) or r.random() < 0.02))
    return rows


def test_mined_rules_and_brute_force(spark):
    rows = labelled()
    df = spark.createDataFrame(rows, "page_id long, url string, block boolean")
    rules = mine(df)
    assert rules and all({"q=aff"} < set(r[0]) and any("spam-farm" in t for t in r[0]) for r in rules)
    own = {r.page_id: set(r.t) for r in df.select("page_id", tokens_of(df.url).alias("t")).collect()}
    for tokens, confidence, support in rules:
        fit = [b for i, _, b in rows if tokens <= own[i]]
        assert abs(sum(fit) / len(fit) - confidence) < 1e-9 and abs(sum(fit) / len(rows) - support) < 1e-9
    for r in judge(df, RULES, df).collect():
        fits = [t for t, *_ in rules if t <= own[r.page_id]]
        assert r.verdict == ("block" if fits else "allow") and (r.mined is not None) == bool(fits)


def test_edges(spark):
    schema = "page_id long, url string, block boolean"
    empty = spark.createDataFrame([], schema)
    assert judge(empty, RULES, empty).count() == 0 and mine(empty) == []
    assert mine(spark.createDataFrame([(1, None, True), (2, "http://a.b/c", None)], schema)) == []
    assert mine(spark.createDataFrame([(1, "http://a.b/c", True)], schema)) == []


def test_rules_of_four_tokens_and_high_base_rates(spark):
    """Four tokens that block only together; and a table in which most URLs are blocked."""
    r = random.Random(6)
    rows = []
    for i in range(1200):
        have = [r.random() < 0.6 for _ in range(4)]
        rows.append((i, f"http://h{i % 5}.test/" + "/".join(f"p{'abcd'[k]}" for k in range(4) if have[k]), all(have)))
    rules = mine(spark.createDataFrame(rows, "page_id long, url string, block boolean"))
    assert {t for t, *_ in rules} == {frozenset(f"p=p{x}" for x in "abcd")}
    most = [(i, f"http://{'bad' if i % 10 < 7 else 'good'}.test/{i}", i % 10 < 7 or i % 20 == 9) for i in range(600)]
    found = mine(spark.createDataFrame(most, "page_id long, url string, block boolean"))
    assert frozenset(["h=bad"]) in {t for t, *_ in found} and not any(t <= {"h=good", "h=test", "p=#"} for t, *_ in found)
