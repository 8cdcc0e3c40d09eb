"""The URL filter: rules against a plain version, and what the trees learn."""

from __future__ import annotations

import re

from tidegauge.llm import queries, urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fitting = [
        (len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fitting)[1:] if fitting else (None, None)


def check(df, rows):
    got = df.collect()
    key = lambda x: repr(x)
    want = []
    for page, url in rows:
        host, path = parts(url)
        want.append((page, host, path, rule(host, path)[0]))
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.verdict in ("allow", "block") and 0 <= r.score <= 1
        if r.rule:
            assert r.verdict == rule(r.host, r.path)[1]
    return got


def test_op8_query(spark, sf):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = check(queries.op8_urls(spark, sf), rows)
    ruled = [r for r in got if r.rule]
    right = sum((r.score >= 0.5) == (r.verdict == "block") for r in ruled)
    assert right >= 0.95 * len(ruled) and len(ruled) < len(got)


def write(spark, path, rows):
    spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string").write.parquet(f"{path}/pages.parquet")


def test_odd_rows(spark, tmp_path):
    odd = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://A.Example.COM/en/x?y=1#z"), (6, "https://www.example.com/en/"),
        (7, "http://x.net/es/1"), (8, "http://net/fr/"), (9, "http://x.net/en/"), (10, "http://notexample.com/en/1"),
        (11, "http://example.com?x=http://b.net/es/"), (12, "a://b://c/d"), (13, "http://É.COM/\n/en"), (7, "http://x.net/es/1"),
        (None, "http://x.org/"), (14, "http://x.org/" + "a/" * 50_000), (15, "HTTP://EXAMPLE.com#/en/"), (16, "http://com"),
    ]
    write(spark, f"{tmp_path}/a", odd)
    check(queries.op8_urls(spark, f"{tmp_path}/a"), odd)
    write(spark, f"{tmp_path}/b", [])
    assert queries.op8_urls(spark, f"{tmp_path}/b").collect() == []
    one_kind = [(1, "http://a.com/"), (2, "http://b.org/")]
    write(spark, f"{tmp_path}/c", one_kind)
    assert {r.verdict for r in check(queries.op8_urls(spark, f"{tmp_path}/c"), one_kind)} == {"allow"}
