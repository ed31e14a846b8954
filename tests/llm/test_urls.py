"""URL rules against the check SQL and a plain search."""

from __future__ import annotations

import random
import re

from compare import connect, differences

from tripweave.llm import urls
from tripweave.llm.common import ready

SF = "/root/testdata/sf0.01"


def plain(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if host and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            best = max(best or (0, False, "", ""), (len(rule), verdict == "block", rule, verdict))
    return (host, path, best[2] if best else None, best[3] if best else "allow")


def test_against_sql(spark):
    con = connect(SF)
    assert differences(urls.op3_url_filter(spark, SF), con.sql(urls.OP3_SQL)) is None


def test_against_plain_search(spark):
    ready(spark)
    rng = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "net", "É.net", "", "a.com:80", "a..com", "com."]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/es/p//q", "/EN/", "//", "/en/x", "/é/x\ny"]
    rules = [("com", "allow"), ("a.com/", "block"), ("a.com/en", "allow"), ("b.a.com/en/x/", "block"), ("net/es/p//", "block"),
             ("a.com/en", "block"), ("com/", "allow"), ("com/é/", "block"), ("a.com/", "block")]
    rows = [(k, f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#x'])}") for k in range(400)]
    rows += [(401, None), (402, ""), (403, "a.com/en/"), (None, "x://A.COM/en/"), (5, "http://a.com/"), (5, "http://a.com/"), (6, "://://a.com/")]
    rows.append((407, "http://" + "a." * 5_000 + "com/" + "x/" * 5_000))
    pages = spark.createDataFrame([(*r, "h", "v") for r in rows], "page_id long, url string, host string, verdict string")
    table = spark.createDataFrame(rules, "rule string, verdict string")
    got = sorted((tuple(r) for r in urls.judge(pages, table).collect()), key=str)
    assert got == sorted(((i, *plain(u, rules)) for i, u in rows), key=str)
    assert urls.judge(pages.limit(0), table).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_main_path_is_built_in(spark):
    plan = urls.op3_url_filter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
