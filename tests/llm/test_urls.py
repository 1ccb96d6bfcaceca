"""URL filters: the index against all rules on all URLs, and against rules restated by hand."""

import functools
import random
import re

import pyarrow.parquet as pq

from revgraph.llm import urls
from revgraph.llm.urls import ALLOW, BLOCK, HOST_RULES, PATTERN_RULES, HostRule, Index, PatternRule, split_url

URLS = [
    "http://example.org/es/1", "https://www.example.org/en/1234?x=1", "https://example.org/en/2", "https://badexample.org/es/9",
    "http://shop.example.com/de/", "http://a.com/fr/x#top", "https://EXAMPLE.ORG/es/", "http://example.org", "http://example.org?q=/es/", "http://org/", "http://example.org:80/es/",
    "https://www.cheap-pills.example.net/en/1", "https://cheap-pills.example.com/fr/2", "https://x.net/adclick?u=1", "https://x.net/adclicks", "https://pills.edu/adclick/",
    "ftp://a.net", "no scheme", "://", "", None, "http://a.net/\n/adclick", "http://best-casino.site.net/", "http://é.net/fr/", "http://x.net/" + "a/" * 100_000 + "adclick",
]


@functools.cache
def compiled(pattern):
    return urls.compile_pattern(pattern)[0]


def every_rule(url, hosts=HOST_RULES, patterns=PATTERN_RULES):
    """Host rules by string tests, patterns each on every URL."""
    host, path = split_url(url)
    fit = [r for r in hosts if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        best = max(fit, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict
    low = (url or "").translate(urls._ASCII)
    met = {p.verdict for p in patterns if compiled(p).search(low)}
    return host, path, None, BLOCK if met == {BLOCK} else ALLOW


def test_equals_all_rules(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[0]), (0, URLS[0])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted(map(tuple, urls.judge_urls(df).drop("pattern").collect()), key=str)
    assert got == sorted(((i, *every_rule(u)) for i, u in rows), key=str)


def test_by_hand():
    index = Index(HOST_RULES, PATTERN_RULES)
    says = {u: index.judge(u)[2:] for u in URLS}
    assert says["http://example.org/es/1"] == ("example.org/es/", BLOCK, None)
    assert says["https://www.example.org/en/1234?x=1"] == ("example.org/en/1", BLOCK, None)
    assert says["https://badexample.org/es/9"] == ("org/", ALLOW, None)
    assert says["http://example.org"] == (None, ALLOW, None) and says["http://org/"] == ("org/", ALLOW, None)
    assert says["http://example.org:80/es/"] == (None, ALLOW, None)  # the port is part of the host
    assert says["https://www.cheap-pills.example.net/en/1"] == (None, BLOCK, "||cheap-pills.")
    assert says["https://cheap-pills.example.com/fr/2"] == ("com/fr/", ALLOW, None)
    assert says["https://x.net/adclick?u=1"][1] == BLOCK and says["https://x.net/adclicks"][1] == ALLOW
    assert says["https://pills.edu/adclick/"] == (None, ALLOW, "||*.edu/") or says["https://pills.edu/adclick/"][1] == BLOCK
    assert says["http://best-casino.site.net/"][1] == BLOCK and says[None] == (None, ALLOW, None)


def test_only_candidates_run():
    """Ten thousand rules: each URL tries those filed under its tokens, and the answer is that of all."""
    rng = random.Random(5)
    hosts = [HostRule(rng.choice([ALLOW, BLOCK]), f"site{i}.net", f"/{rng.choice('abc')}/") for i in range(5000)]
    patterns = [PatternRule(rng.choice([ALLOW, BLOCK]), f"/track{i}^") for i in range(5000)] + [PatternRule(BLOCK, "zz*top")]
    pages = [f"http://www.site{rng.randrange(6000)}.net/{rng.choice('abcd')}/track{rng.randrange(6000)}/x" for _ in range(300)] + ["http://q.net/zz/stop"]
    index = Index(hosts, patterns)
    assert index.every == [len(hosts) + len(patterns) - 1]
    for u in pages:
        assert index.judge(u)[:4] == every_rule(u, hosts, patterns)
    assert index.runs <= 4 * len(pages)


def test_rarest_token_of_the_table_files_a_rule(spark):
    df = spark.createDataFrame([(1, "http://common.net/rare/"), (2, "http://common.net/x"), (3, None)], "page_id long, url string")
    rule = HostRule(BLOCK, "common.net", "/rare/")
    assert list(urls.build_index(df, [rule], []).by_token) == ["rare"]
    again = spark.createDataFrame([(1, "http://a.net/rare/"), (2, "http://b.net/rare/")], "page_id long, url string")
    assert list(urls.build_index(again, [rule], []).by_token) == ["common"]


def test_literal_tokens():
    assert urls.compile_pattern(PatternRule(BLOCK, "||ads*.x.net/a^b"))[1] == {"x", "net", "a"}
    assert urls.compile_pattern(PatternRule(BLOCK, "ads"))[1] == set()
    assert urls.compile_pattern(PatternRule(BLOCK, "|http://a.net|"))[1] == {"http", "a", "net"}
    assert urls.compile_host(HostRule(BLOCK, "a.net", "/en/1"))[1] == {"a", "net", "en"}
    assert urls.compile_host(HostRule(BLOCK, "", "/en/"))[0].match("any.host/en/2")


def test_spam_hosts_of_the_table_and_empty_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("host", spelling_clash()).withColumn("token", spelling_clash())
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages).where("rule IS NULL").collect()}
    table = pq.read_table("/root/testdata/sf0.01/pages.parquet").select(["page_id", "url"]).to_pylist()
    assert got and all(got[r["page_id"]] == (BLOCK if re.search("cheap-pills", r["url"]) else ALLOW) for r in table if r["page_id"] in got)
    assert urls.judge_urls(pages.limit(0)).count() == 0


def spelling_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")
