from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from partnerwatch.llm import url_filter as U
from partnerwatch.llm.queries import URL_RULES
from tests.llm.data import rows

HOST = st.lists(st.sampled_from(["a", "b", "net", "example", ""]), min_size=1, max_size=4).map(".".join)
PATH = st.one_of(st.just(""), st.lists(st.sampled_from(["", "en", "e", "x"]), max_size=4).map(lambda s: "/" + "/".join(s)))


def brute(rules, host, path):
    fit = [
        (len(h.split(".")), len(s + p), v == "block", r, v)
        for r, v in rules
        for h, s, p in [r.partition("/")]
        if (host == h or host.endswith("." + h)) and path.startswith(s + p)
    ]
    return max(fit)[3:] if fit else None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HOST, PATH, st.sampled_from(["allow", "block"])), max_size=8), HOST, PATH)
def test_trie_finds_what_a_scan_of_all_rules_finds(rules, host, path):
    rules = [(h + p, v) for h, p, v in rules]
    trie = U.RuleTrie()
    for r, v in rules:
        trie.add(r, v)
    found = trie.match(host, path)
    assert (found and found[1:]) == brute(rules, host, path)


def test_verdicts_and_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?q#f", "http://example.net/de", "ftp://x.net", "x://org/fr/" + "y/" * 20000, "x://org/fr", "x://notnet/", "http://a.net/a://b/"]
    df = spark.createDataFrame([(i, u, "mine", "h") for i, u in enumerate(urls)], "page_id long, url string, rule string, other string")
    got = {r["page_id"]: r for r in U.url_verdicts(df, URL_RULES).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in range(3)] == [("", "")] * 3
    assert (got[4]["host"], got[4]["path"], got[4]["rule"], got[4]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert [got[i]["rule"] for i in (5, 6, 7, 8, 9)] == ["net/", None, "org/fr/", None, None]
    assert [got[i]["verdict"] for i in (0, 5, 9)] == ["allow", "block", "allow"]
    assert got[10]["rule"] == "net/" and got[10]["other"] == "h"
    assert rows(U.url_verdicts(df.limit(0), URL_RULES)) == []
    assert {r["verdict"] for r in U.url_verdicts(df, [], default="block").collect()} == {"block"}


def test_blocks_of_rules_agree_with_one(spark, monkeypatch):
    df = spark.createDataFrame([(1, "http://a.example.net/en/"), (2, "http://a.net/"), (3, "http://example.com/de/z")], "page_id long, url string")
    one = rows(U.url_verdicts(df, URL_RULES), "page_id")
    monkeypatch.setattr(U, "BLOCK_CHARS", 5)
    assert len(list(U._blocks(URL_RULES))) == 4
    assert rows(U.url_verdicts(df, URL_RULES), "page_id") == one
