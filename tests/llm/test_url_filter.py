from __future__ import annotations

import random
import re

from ledgerline.llm.url_filter import GlobAutomaton, glob_rule, judge_urls, op1_url_filter, suffix_rule
from tests.llm.samples import clashing

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1:] if fit else (None, None)


URLS = [None, "", "no-scheme.org/x", "http://", "https://Example.ORG/es/1", "http://example.org", "http://example.org?x=/es/",
        "http://notexample.org/es/", "http://a.b.example.org/en/12#f", "http://x.com/fr/a?b", "http://x.com/de/", "http://com/de/x",
        "http://x.net/com/de/", "http://evil.net/x.org/y", "http://spam-farm.example.com/en/1", "http://www.cheap-pills.net/a",
        "ftp://É.org/ü://z", "http://y.org/" + "p" * 5000, "http://x.com/fr/a?b", "a://b://c.org/d", "http://h\nost.org/\n/es"]


def test_query_equals_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(URLS)], "page_id bigint, url string, html string")
    for r in op1_url_filter(pages).collect():
        host, path, (rule, verdict) = brute(URLS[r.page_id])
        spam = path.startswith("/") and any(s in host for s in ("spam-farm", "cheap-pills", "casino"))
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict == (verdict or ("block" if spam else "allow")), r


def test_automaton_equals_globs_over_many_words():
    rng = random.Random(3)
    for _ in range(300):
        globs = ["".join(rng.choice("ab/.*") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
        texts = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 20))).encode() for _ in range(20)]
        got = GlobAutomaton(globs).match(texts)
        for j, g in enumerate(globs):
            host, slash, path = g.partition("/")
            pattern = re.escape(host).replace(r"\*", "[^/]*") + re.escape(slash) + re.escape(path).replace(r"\*", ".*")
            assert [bool(re.fullmatch(pattern, t.decode(), re.S)) for t in texts] == got[:, j].tolist(), g


def test_ties_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([("http://a.org/x",), ("http://a.org/x",)], "url string")
    rules = [suffix_rule("first", "org"), suffix_rule("second", "org"), glob_rule("third", "*.org/*")]
    out = judge_urls(clashing(df), "url", rules).collect()
    assert [r.url_judgement_.verdict for r in out] == ["first", "first"] and out[0].rule == "rule"
    assert judge_urls(df.limit(0), "url", rules).collect() == []
