import re

import duckdb
from pyspark.sql import functions as F

from tarnlake.llm import queries
from tarnlake.llm.urls import RULES, filter_urls, host_reputation, page_outcomes, registered_domain


def expected(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, best[0] if best else None, best and best[1]


def test_hosts_paths_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/x?q", "https://example.org/en/12#f", "ftp://xorg/fr/", "http://é.com/fr/"]
    urls += ["http://com/de/1", "http://a.b.com/de/", "x://h?/fr/", "http://u:p@h.org:80/a b", "://org/", "a://b://c/d", "http://COM/fr/é#"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: r for r in filter_urls(df, none).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = expected(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or "allow")


def test_reputation_shrinks_and_blocks(spark):
    rows = [(i, f"http://bad{i % 2}.farm.net/p{i}") for i in range(60)] + [(100 + i, f"http://s{i % 9}.good.net/") for i in range(90)]
    rows += [(300, "http://new.farm.net/"), (301, "http://new.good.net/"), (None, "http://s1.good.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    seen = [(i, True) for i in range(60)] + [(100 + i, i % 30 == 0) for i in range(90)] + [(None, True), (5, None), (100, False)]
    outcomes = spark.createDataFrame(seen, "page_id long, bad boolean")
    rep = {r.host: r for r in host_reputation(pages, outcomes).collect()}
    assert rep["bad0.farm.net"].n == 30 and rep["bad0.farm.net"].bad == 30
    assert rep["new.farm.net"].bad_rate > rep["new.good.net"].bad_rate
    assert 0 < rep["s1.good.net"].bad_rate < 0.3
    got = {r.page_id: r.verdict for r in filter_urls(pages, outcomes).collect()}
    assert got[3] == "block" and got[101] == "allow"
    assert filter_urls(pages.limit(0), outcomes).count() == 0
    assert filter_urls(pages, outcomes.limit(0)).where("verdict = 'block'").count() == 0


def test_query_blocks_hosts_as_its_sql_does(spark, tmp_path):
    page = "<style>p > a { # }</style><!-- a > b ### --><p class='x'>" + " ".join(f"word{j}" for j in range(30)) + "</p><SCRIPT>a(); ###</SCRIPT>"
    rows = [(i, f"http://www.casino-{i % 3}.example.net/p{i}", page) for i in range(300)]
    rows += [(1000 + i, f"http://h{i % 40}.example.{('net', 'com')[i % 2]}:80/p{i}", page) for i in range(800)]
    rows += [(2000 + i, "http://noisy.site.co.uk/", page + "<p>" + "### &amp;&amp; " * 40) for i in range(50)]
    rows += [(2200 + i, "http://again.site.co.uk/", "<p>the same few words once more, </p>\n" * 30) for i in range(50)] + [(2300 + i, "http://thin.site.co.uk/", "<p>nothing") for i in range(50)]
    rows += [(2400 + i, "http://hot.site.com/", page + "<p>" + " ".join(f"w{j}" for j in range(5000))) for i in range(3)] + [(2100 + i, "http://u@10.0.0.1:8080/", None) for i in range(9)]
    rows += [(3000, None, None), (3000, None, "***"), (None, "http://x.example.com/", "x"), (3001, "http://" + "a" * 100_000 + ".com/" + "b" * 100_000, "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in queries.op9_url_reputation(spark, str(tmp_path)).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted((tuple(r) for r in con.execute(queries.ORACLE_SQL["op9_url_reputation"]).fetchall()), key=repr)
    blocked = {r[1] for r in got if r[4] == "block"}
    assert blocked == {"www.casino-0.example.net", "www.casino-1.example.net", "www.casino-2.example.net", "noisy.site.co.uk", "again.site.co.uk", "thin.site.co.uk"}


def test_registered_domains(spark):
    hosts = {"a.b.example.org": ("example.org", "org"), "u:p@x.co.uk:80": ("x.co.uk", "co.uk"), "10.0.0.1:80": ("10.0.0.1", ""), "[::1]:80": ("[::1]", ""), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    assert {r.host: (r[1], r[2]) for r in df.select("host", *registered_domain(F.col("host"))).collect()} == hosts
    assert page_outcomes(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_outcomes_are_measured_on_the_text(spark):
    words = " ".join(f"w{i}" for i in range(100))
    html = {1: (None, False), 2: ("", True), 3: (f"<p>{words}", False), 4: (f"<p>{words}{'#' * 11}", True), 5: (f"<p>{words}{'#' * 10}", False)}
    html |= {6: (f"<p>{words} {words}", True), 7: ("<p>" + "one two three " * 3, True), 8: (f"<script>{'# ' * 90}</script>{words}", False), 9: (f"<!-- {words} --><p>few words", True)}
    html |= {10: (f"<p>{words} " + " ".join(f"w{i}" for i in range(24)), False)}  # 20 of 120 windows
    df = spark.createDataFrame([(i, "http://a.org/", h) for i, (h, _) in html.items()], "page_id long, url string, html string")
    assert dict(page_outcomes(df).collect()) == {i: bad for i, (_, bad) in html.items()}


def test_columns_of_any_name_stay(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "mine"), (2, None, "too")], "page_id long, url string, _rule string")
    out = filter_urls(pages, spark.createDataFrame([], "page_id long, bad boolean"))
    assert {r.page_id: (r["_rule"], r.rule) for r in out.collect()} == {1: ("mine", "org/"), 2: ("too", None)}
