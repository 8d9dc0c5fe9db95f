"""URL filters: explicit rules against a loop, mined rules against counted combinations."""

from itertools import combinations

from panelcast.llm import urls


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [h + p for _, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/1?x=http://b#c", "http://example.net", "http://net/",
    "http://xexample.com/de/", "http://example.com/de/x", "http://example.com/den", "http://www.org/fr/1", "HTTP://ÄB.ORG/fr/",
    "a://b://c/d", "http://x.net?y", "http://x.net#y/", "http://spam.example.com/es/9#top", "http://ok.example.com/es/9",
    "http://spam.example.com/fr/7?a=1&b", "x\n://q.org/fr/\n",
]


def test_host_path_rule_and_verdict(spark):
    pages = spark.createDataFrame([(i, u, "e") for i, u in enumerate(URLS)] + [(4, URLS[4], "e")], "page_id long, url string, t string")
    labelled = [(f"http://spam.example.com/es/{i}", True) for i in range(8)] + [(f"http://ok.example.com/es/{i}", False) for i in range(8)]
    labelled += [(None, True), ("http://a.org/", None)]
    out = urls.filter_urls(pages, spark.createDataFrame(labelled, "url string, blocked boolean")).collect()
    assert len(out) == len(URLS) + 1 and all(r["t"] == "e" for r in out)
    verdicts = {h + p: v for v, h, p in urls.RULES}
    for r in out:
        host, path, rule = brute_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r["url"]
        assert r["verdict"] == (verdicts[rule] if rule else "block" if "spam" in host else "allow")


def test_mined_rules_equal_counted_combinations(spark):
    rows = [(["a", "b", "c"], True), (["a", "b"], True), (["a", "c"], False), (["b", "c"], False), (["a", "b", "d"], True), (["d"], False)]
    mining = urls.Mining(min_support=0.3, min_confidence=0.7)
    got = urls.mine(spark.createDataFrame(rows, "_items array<string>, blocked boolean"), mining).collect()
    kept = {}
    for k in (1, 2, 3):
        for need in combinations("abcd", k):
            held = [b for items, b in rows if set(need) <= set(items)]
            if sum(held) / len(rows) >= 0.3 and sum(held) / len(held) >= 0.7:
                if not any(set(s) < set(need) and kept[s] >= sum(held) / len(held) for s in kept):
                    kept[need] = sum(held) / len(held)
    assert {tuple(r["need"]): r["confidence"] for r in got} == kept and kept


def test_nothing_learnt_and_empty_table(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    pages = spark.createDataFrame([(1, "http://a.example.com/x/1")], "page_id long, url string")
    assert [r["verdict"] for r in urls.filter_urls(pages, none).collect()] == ["allow"]
    assert urls.filter_urls(pages.limit(0), none).count() == 0
