import random

import duckdb
from conformance import compare
from odd import CLASHING, ids

from segspark.llm.queries import OP1_SQL, URL_RULES
from segspark.llm.url_trust import judge_pages


def made(seed, n=400):
    """Linked hosts: some with allowed or blocked urls, a hub that a third of all pages belong to."""
    random.seed(seed)
    hosts = ["hub.test"] * 20 + [f"h{i}.test" for i in range(40)] + ["a.org", "m.b.com", "c.com", "www.example.org", "x.example.org"]
    rows = []
    for i in range(n):
        host = random.choice(hosts)
        path = random.choice(["/", "/fr/1", "/de/2", "/es/3", "/en/1x", "/en/2", ""])
        links = "".join(f'<A class="x" HREF="{random.choice(["http://", "HTTPS://", "//"])}{random.choice(hosts)}/p?q">x</a>' for _ in range(random.randint(0, 3)))
        rows.append((i, f"http://{host.upper() if i % 5 == 0 else host}{path}{random.choice(['', '?x://y', '#z'])}", f'<p>{links}<a href="/own">o</a>'))
    return rows


def test_equal_to_sql_on_linked_pages(spark):
    verdicts = set()
    for seed in range(3):
        rows = made(seed)
        con = duckdb.connect()
        con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
        con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
        out = judge_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), URL_RULES)
        assert compare(out, con, OP1_SQL) is None
        verdicts |= {(r["rule"] is None, r["verdict"]) for r in out.select("rule", "verdict").collect()}
    assert verdicts == {(a, b) for a in (True, False) for b in ("allow", "block")}


def test_rules(spark):
    urls = {
        "http://a.org/x": ("org/", "allow"), "http://A.ORG/x": ("org/", "allow"), "http://a.org": (None, "allow"), "x://example.org/es/1": ("example.org/es/", "block"),
        "x://m.example.org/es": ("org/", "allow"), "x://notexample.org/es/": ("org/", "allow"), "x://example.org/en/17": ("example.org/en/1", "block"),
        "x://b.com/fr/?a": ("com/fr/", "allow"), "x://b.com/fr": (None, "allow"), "x://com/de/": ("com/de/", "block"), "no scheme": (None, "allow"),
    }
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_pages(df, URL_RULES).collect()}
    assert got == dict(enumerate(urls.values()))


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "a\nb://H/p?q", "<a href='x://y/z'>" * 5000), (3, "a\nb://H/p?q", None), (None, "://", "<a href=>"), (None, None, None)]
    df = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    out = judge_pages(df, URL_RULES)
    assert ids(out, "page_id") == [1, 2, 3, 3, None, None]
    by = {r["page_id"]: r for r in out.collect()}
    assert (by[1]["host"], by[1]["path"], by[3]["host"], by[3]["path"]) == ("", "", "h", "/p")
    assert {r["verdict"] for r in by.values()} == {"allow"}
    assert judge_pages(df.limit(0), URL_RULES).isEmpty()
