"""URL rules against a plain matcher."""

from __future__ import annotations

import re
from pathlib import Path

from ledgerloom.llm import url_rules
from ledgerloom.llm.queries import URL_RULES

URLS = [
    None, "", "nothing", "http://", "https://ORG", "https://ORG/", "http://a.org/x", "http://xorg/x",
    "http://example.org/es/1", "http://m.example.org/es/", "http://example.org/es", "http://example.org?/es/",
    "http://example.org/en/1", "http://example.org/en/19?x", "http://example.org/en/2", "http://notexample.org/es/",
    "http://Example.COM/fr/", "http://a.b.example.com/de/x#y", "http://com/de/", "ftp://x.com/FR/",
    "http://example.com/fr/a://b.org/es/", "://org/", "http://example.org:80/es/", "http://é.org/es/",
    "http://a..org/", "http://.org/", "x\ny://a.org/\nz?q", "http://example.org/en/1" + "0" * 100_000,
    "http://org", "http://example.org/es/", "http://example.org/es/",
]


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [
        (len(h + p), len(h), v == "block", h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def judged(spark, rules, urls=URLS):
    rows = [(n, u, "keep", "h") for n, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, extra string, host string")
    return url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()


def test_the_registered_rules(spark):
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, URL_RULES)}
    assert found == {n: plain(u, URL_RULES) for n, u in enumerate(URLS)}


def test_repeated_conflicting_and_missing_rules(spark):
    rules = [*URL_RULES, ("block", "org", "/"), ("allow", "a.b.example.com", ""), ("block", "b.example.com", "/d")]
    rules += [("allow", "example.com", "/fr/a"), ("block", "", "/"), ("block", None, "/"), ("allow", "org", None)]
    usable = [r for r in rules if None not in r]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, rules)}
    wanted = {n: plain(u, [r for r in usable if r[1]]) for n, u in enumerate(URLS)}
    assert found == wanted
    assert all(r.rule is None and r.verdict == "allow" for r in judged(spark, []))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES)).count() == 0


def test_no_python_in_the_plan(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    frame = url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_rules_are_made_by_dataframe_functions(spark):
    assert "arrow" not in Path(url_rules.__file__).read_text()
    rules = [*URL_RULES, ("block", None, "/"), ("allow", "org", None), ("allow", "org", None)]
    assert sorted(map(str, url_rules.rule_table(spark, rules).collect())) == sorted(
        f"Row(verdict={v!r}, host={h!r}, path={p!r})" for v, h, p in rules
    )
