"""The trie against trying every rule on every URL."""

import random
import time

import pytest

from kerbstream.llm import url_filter as uf

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"), ("block", "example.net", "/en/x/"), ("block", "a.example.net", "/"),
         ("allow", "b.net", ""), ("block", "com", "/de"), ("allow", "com", "/de/a/b")]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (r[1].count("."), len(r[2])), default=None)
    return (host, path, best and best[1] + best[2], best[0] if best else default)


def some_urls():
    chance = random.Random(5)
    hosts = ["net", "example.net", "A.Example.NET", "x.a.example.net", "example.com", "q.org", "org",
             "notnet", "b.net", "example.net:80", "", "com", "..net", "É.net"]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/de", "/de/", "/dea", "/de/a/b", "/de/a/bc", "/fr/a",
             "//en/", "/EN/"]
    tails = ["", "?a=/en/", "#x", "?q#y", "?u=http://z.net/"]
    urls = [chance.choice(["http://", "HTTPS://", "://", "//", ""]) + chance.choice(hosts)
            + chance.choice(paths) + chance.choice(tails) for _ in range(400)]
    return [*urls, None, "", "://", "a://b://c.net/", "http://x.net\n/en/", *urls[:5]]


@pytest.mark.parametrize("trie_rules", [1, 2, 100])
def test_against_every_rule(spark, trie_rules):
    urls = some_urls()
    pages = spark.createDataFrame(
        [(i, u, "other") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in uf.judge_urls(pages, RULES, trie_rules=trie_rules).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_default_and_no_rules(spark):
    pages = spark.createDataFrame([(None, "http://a.b/")], "page_id long, url string")
    assert uf.judge_urls(pages, [], default="block").collect() == [
        (None, "http://a.b/", "a.b", "/", None, "block")]


def test_empty_table_and_later_rule_counts(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge_urls(pages, RULES).collect() == []
    pages = spark.createDataFrame([(1, "x://a.b/")], "page_id long, url string")
    twice = [("block", "a.b", "/"), ("allow", "A.B", "/")]
    assert uf.judge_urls(pages, twice, trie_rules=1).first().verdict == "allow"


@pytest.mark.parametrize("rule", [("block", "", "/"), ("deny", "a", "/"), ("allow", "a" * 5000, "")])
def test_bad_rules_are_refused(spark, rule):
    pages = spark.createDataFrame([], "page_id long, url string")
    with pytest.raises(ValueError):
        uf.judge_urls(pages, [rule])


def test_tries_are_bounded_in_characters(monkeypatch):
    monkeypatch.setattr(uf, "TRIE_CHARS", 20)
    rules = [uf.Rule("block", "h" * n, "/") for n in (5, 5, 19, 30, 1)]
    assert [[len(r.host) for r in part] for part in uf._parts(rules, 100)] == [
        [5, 5], [19], [30], [1]]


def test_long_urls_take_linear_time():
    """Segments of one character over and over, which no rule ends."""
    trie = uf.HostTrie([uf.Rule("block", "a.b", "/x" + "x" * n) for n in (0, 5, 4000)])
    start = time.perf_counter()
    found = trie.longest("a.b", "/" + "x" * 2_000_000)
    assert found[1] == 4002 and trie.longest("a.b", "/" + "y" * 2_000_000) is None
    assert trie.longest("b." * 500_000 + "a.b", "/" * 1_000_000) is None
    assert time.perf_counter() - start < 2


def test_columns_of_any_name_stay(spark):
    pages = spark.createDataFrame(
        [(1, "http://x.net/a", "h", "b", "d", "f", "r")],
        ["page_id", "url", "Host", "_best", "a.b`c", "found", "row"])
    got = uf.judge_urls(pages, RULES)
    assert got.columns == ["page_id", "url", "_best", "a.b`c", "found", "row", "host", "path", "rule",
                           "verdict"]
    assert tuple(got.first()) == (1, "http://x.net/a", "b", "d", "f", "r", "x.net", "/a", "net/",
                                  "block")
