import math
import re

from kilowatch.llm.common import table
from kilowatch.llm.queries import URL_RULES
from kilowatch.llm.urlfilter import filter_urls, lexical
from pyspark.sql import functions as F
from tests.conftest import SF_DIR
from tests.llm.fixtures import with_clashes

PAGES = "page_id long, url string, html string"


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = []
    for verdict, rule in URL_RULES:
        rule_host, rest = rule.split("/", 1)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_on_all_pages(spark):
    pages = table(spark, SF_DIR, "pages")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    got = filter_urls(pages, URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.5 else "allow"))


def test_odd_urls(spark):
    urls = [None, "", "nothing", "http://", "HTTP://EXAMPLE.ORG/es/1?x", "x://ÄB.Com/fr/", "a://org", "b://myorg/", "c://a.org?/", "d://org/" + "é" * 50_000,
            "e://example.org/en/1#", "e://example.org/en/2", "f://x.com/de/://y.org/"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] * 2, PAGES)
    pages = with_clashes(pages, "host", "path", "hit", "verdict", "label", "f_length")
    got = filter_urls(pages, URL_RULES).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict in (None, r["verdict"])


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], PAGES)
    assert filter_urls(empty, URL_RULES).collect() == []
    pages = spark.createDataFrame([(1, "a://x.net/", None), (2, "a://x.com/de/", None)], PAGES)
    assert {r["page_id"]: r["verdict"] for r in filter_urls(pages, URL_RULES).collect()} == {1: "block", 2: "block"}
    assert {r["verdict"] for r in filter_urls(pages, []).collect()} == {"allow"}


def test_trees_learn_from_labels(spark):
    good = [f"https://news{i}.example.net/story/{i}" for i in range(80)]
    bad = [f"http://win{i}{i * 7}.casino{i}.biz/p{i * 991}?id={i}&a={i * 3}&b=1" for i in range(80)]
    labelled = spark.createDataFrame([(u, 0) for u in good[:60]] + [(u, 1) for u in bad[:60]], "url string, label int")
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(good[60:] + bad[60:])], PAGES)
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages, [], labelled).collect()}
    assert sum(got[i] == ("allow" if i < 20 else "block") for i in got) >= 38


def test_features(spark):
    url = "http://a1.example.org/x//y/22?p=1&&q#z"
    df = spark.createDataFrame([(url, "/x//y/22"), (None, "")], "url string, path string")
    got = df.select(*[c.alias(n) for n, c in lexical(F.col("url"), F.col("path")).items()]).collect()
    n = len(url)
    entropy = -sum(url.count(c) / n * math.log2(url.count(c) / n) for c in set(url))
    assert got[0]["f_length"] == n and got[0]["f_depth"] == 3 and got[0]["f_params"] == 2
    assert math.isclose(got[0]["f_entropy"], entropy) and math.isclose(got[0]["f_digits"], 4 / n)
    assert tuple(got[1])[:1] == (0.0,)
