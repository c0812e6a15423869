import random

from ratelattice.llm import queries, urlrules

URLS = [
    None, "", "no scheme", "http://", "https://WWW.Example.com/en/a?x#y", "https://www.example.com/en", "http://a.example.com/en/", "http://example.com",
    "http://example.com?u=://www.example.com/en/", "ftp://notexample.com/en/x", "https://x.net/es/a", "https://net/fr/", "https://x.net/de/", "http://com/",
    "http://.com/", "http://a..com/x", "x://y.com/a/é/ü#z", "http://example.com:80/en/", "a://b://c.com/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail.split("?")[0].split("#")[0]


def brute(url, rules, otherwise="allow"):
    host, path = parts(url)
    fits = [(len(h) + len(p), v, h + p) for h, p, v in rules if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, otherwise, None))
    return host, path, best[2], best[1]


def run(spark, rows, rules, **more):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    return urlrules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), **more).collect()


def test_contract_rules(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, "http://a.com/", "h", "r")] * 2
    got = run(spark, rows, list(queries.RULES))
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=key) == sorted(((i, *brute(u, queries.RULES)) for i, u, *_ in rows), key=key)


def test_random_rules(spark):
    rng = random.Random(0)
    hosts, paths = ["a.b", "b", "c.a.b", "x", ""], ["", "/", "/p", "/p/", "/p/q", "/pq"]
    rules = [(rng.choice(hosts), rng.choice(paths), "block") for _ in range(12)] + [(None, "/", "block"), ("b", None, "block")]
    rows = [(i, f"s://{rng.choice(['z.', 'a.', ''])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'q', '/r?'])}", "h", "r") for i in range(200)]
    got = {r.page_id: (r.host, r.path, r.rule and len(r.rule), r.verdict) for r in run(spark, rows, rules)}
    for i, u, *_ in rows:
        host, path, rule, verdict = brute(u, rules)
        assert got[i] == (host, path, rule and len(rule), verdict)


def test_empty_tables(spark):
    assert run(spark, [], list(queries.RULES)) == []
    assert [(r.rule, r.verdict) for r in run(spark, [(1, "http://a.com/", "", "")], [], otherwise="block")] == [(None, "block")]


def test_colliding_short_hashes(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "HASH_PREFIX", 0)
    got = run(spark, [(1, "http://q.com/en/", "", ""), (2, "http://x.org/", "", "")], list(queries.RULES))
    assert sorted((r.page_id, r.rule) for r in got) == [(1, "com/"), (2, None)]
