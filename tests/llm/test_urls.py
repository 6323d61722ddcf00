import random

import pytest

from fareloom.llm import urls

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"),
         ("plain.com", "block"), ("plain.com/a/b", "allow"), ("plain.com/a/", "block"), ("x.plain.com/", "allow"),
         ("plain.com/q", "allow"), ("plain.com/q", "block")]
URLS = [None, "", "no scheme", "http://", "http://A.NET", "http://a.net/", "https://M.Example.NET/en/25?x=1#y",
        "http://example.net/en", "http://notexample.com/de/1", "http://example.com/de/1", "http://org/fr/",
        "http://plain.com", "http://plain.com/a/bcd/e", "http://plain.com/a/c", "http://x.plain.com/a/", "http://plain.com/q",
        "http://u@plain.com:80/a", "x://y://plain.com/a/", "http://é.net/ü", "http://a.net?x=/en/", "http://a.net\n/b", "http://..net/"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, path = rest[:cut], rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), len(h), verdict == "block", rule, verdict))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("limit", [urls.MAX_TRIE_CHARS, 0])
@pytest.mark.parametrize("framed", [False, True])
def test_like_brute_force(spark, limit, framed):
    rng = random.Random(1)
    made = [f"http://{rng.choice(['', 'x.', 'www.'])}{rng.choice(['plain.com', 'example.net', 'b.org'])}"
            f"{rng.choice(['', '/', '/a', '/a/', '/a/b', '/a/bc/d', '/en/', '/fr/x', '/q', '/qq'])}" for _ in range(100)]
    rows = [(i, u, "was", None) for i, u in enumerate(URLS + made + [None])]
    pages = spark.createDataFrame(rows, "page_id long, url string, `host` string, `odd.name` int")
    rules = spark.createDataFrame(RULES, "rule string, verdict string") if framed else RULES
    got = urls.judge_urls(pages, rules, max_trie_chars=limit)
    assert got.columns == ["page_id", "url", "odd.name", "host", "path", "rule", "verdict"]
    assert sorted((r[0], tuple(r[3:])) for r in got.collect()) == [(i, brute(u)) for i, u, *_ in rows]


@pytest.mark.parametrize("limit", [urls.MAX_TRIE_CHARS, -1])
def test_nothing_to_judge_or_no_rules(spark, limit):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(none, RULES, max_trie_chars=limit).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r)[-2:] for r in urls.judge_urls(one, [], max_trie_chars=limit).collect()] == [(None, "allow")]


def test_hosts_and_paths_stay_as_long_as_they_are(spark):
    long = "http://" + "a." * 3000 + "net/" + "p/" * 50_000
    row = urls.judge_urls(spark.createDataFrame([(1, long)], "page_id long, url string"), RULES).first()
    assert row.verdict == "block" and len(row.path) == 100_001


def test_a_very_long_segment_among_many_rules():
    trie = urls.Trie([(f"a.net/{'x' * n}", "block") for n in range(1, 30)] + [("a.net/" + "x" * 400, "allow")])
    assert trie.match("a.net", "/" + "x" * 1_000_000) == ("a.net/" + "x" * 400, "allow")
    assert trie.match("a.net", "/xx" + "y" * 1_000_000) == ("a.net/xx", "block")
    assert trie.match("a.net", "/y") is None
