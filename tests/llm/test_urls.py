import duckdb
from hearth.llm import op9_urls as op
from hearth.llm.oracle import ORACLE
from tests.llm.helpers import crowded

SCHEMA = "page_id long, url string, html string"


def test_hosts_paths_and_rules(spark):
    cases = [
        ("https://a.example.com/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("http://WWW.Example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://x.www.example.com/en/é", "x.www.example.com", "/en/é", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
        ("http://a.net/es", "a.net", "/es", None, "block"),  # no rule fits; the next url is its alias
        ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
        ("http://com", "com", "", None, "allow"),
        ("x://h?a/b://c", "h", "", None, "allow"),
        ("no scheme /en/", "", "", None, "allow"),
        ("", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("http://a.com/line\nbreak", "a.com", "/line\nbreak", "com/", "allow"),
    ]
    d = crowded(spark.createDataFrame([(i, c[0], None) for i, c in enumerate(cases)], SCHEMA), "host", "verdict", "node", "_key")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in op.judge_urls(d).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1:] for c in cases]


def brute(rows, edges, rules):
    """Verdicts by following alias edges from page to page."""
    import re
    key = lambda u: re.sub(r"^(www|m)\.", "", u.split("://")[1].lower()).rstrip("/") if "://" in u else None
    near = {}
    for a, b in edges:
        near.setdefault(key(a), set()).add(key(b))
        near.setdefault(key(b), set()).add(key(a))
    own = {u: rules(u) for _, u in rows}
    out = {}
    for i, u in rows:
        seen, todo = {key(u)}, [key(u)]
        while todo:
            for k in near.get(todo.pop(), ()):
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        alias = {v for w, v in own.items() if v and key(w) in seen}
        out[i] = own[u] or ("allow" if "allow" in alias else "block" if "block" in alias else "allow")
    return out


def test_decisions_reach_aliases(spark):
    import random
    rng = random.Random(3)
    urls = [f"http://{rng.choice(['', 'www.', 'm.'])}s{i}.{rng.choice(['org', 'org', 'net', 'com'])}/{rng.choice(['es', 'en', 'fr'])}/{i}"
            for i in range(120)]
    rows, edges, html = list(enumerate(urls)), [], {}
    for i, u in rows:
        if rng.random() < 0.7:
            t = rng.choice(urls[max(0, i - 6):i + 1])
            edges.append((u, t))
            html[i] = rng.choice([f"<link rel=canonical href='{t}'>", f'<LINK href="{t}" REL="canonical" />',
                                  f'<meta http-equiv="refresh" content="0; url={t}">'])
    d = spark.createDataFrame([(i, u, html.get(i)) for i, u in rows], SCHEMA)
    known = [(urls[0], urls[60]), (urls[5], urls[100])]
    red = spark.createDataFrame(known, "from_url string, to_url string")

    def rules(u):
        host, path = u.split("://")[1].split("/", 1)
        return "allow" if host.endswith(".com") else "block" if host.endswith(".net") and path[:3] in ("es/", "fr/") else None

    want = brute(rows, edges + known, rules)
    got = {r["page_id"]: r["verdict"] for r in op.judge_urls(d, redirects=red).collect()}
    assert got == want and set(want.values()) == {"allow", "block"}
    assert len({r["reason"] for r in op.judge_urls(d, redirects=red).collect()}) == 3


def test_relative_links_repeats_and_empty(spark):
    page = '<link rel="canonical" href="/es/9">'
    rows = [(1, "http://a.org/x", '<link rel="canonical" href="http://b.net/es/9/">'), (1, "http://a.org/x", None),
            (2, "http://www.a.org/x/?utm_source=q", None), (3, "http://b.net/zz", page), (None, "http://a.org/x#f", None)]
    d = spark.createDataFrame(rows, SCHEMA)
    # the page that the links lead to is not in the table: it decides all the same
    assert {(r["page_id"], r["verdict"]) for r in op.judge_urls(d).collect()} == {(1, "block"), (2, "block"), (3, "block"), (None, "block")}
    assert {r["verdict"] for r in op.judge_urls(d, judge_targets=False).collect()} == {"allow"}
    d = d.union(spark.createDataFrame([(9, "https://m.b.net/es/9.html", "")], SCHEMA))
    assert {(r["page_id"], r["verdict"]) for r in op.judge_urls(d).collect()} == {
        (1, "block"), (2, "block"), (3, "block"), (None, "block"), (9, "block")}
    assert op.judge_urls(d.limit(0)).count() == 0


def test_targets_outside_the_table_decide(spark):
    rows = [(1, "http://a.org/x", '<link rel="canonical" href="http://b.net/es/9/">'), (2, "http://www.a.org/x/", None),
            (3, "http://c.org/y", '<meta http-equiv="refresh" content="0; url=http://c.com/">'),
            (4, "http://d.net/es/1", '<link rel="canonical" href="http://d.com/1">'),
            (5, "http://e.org/z", '<link rel="canonical" href="http://f.org/q">'), (6, "http://g.org/1", None), (None, None, None)]
    d = spark.createDataFrame(rows, SCHEMA)
    red = spark.createDataFrame([("http://g.org/1", "http://g.net/fr/1"), ("http://h.net/fr/2", "http://e.org/z"),
                                 (None, "http://e.org/z")], "from_url string, to_url string")

    def got(**kw):
        return {r["page_id"]: (r["verdict"], r["reason"]) for r in op.judge_urls(d, **kw).collect()}

    want = {1: ("block", "alias"), 2: ("block", "alias"), 3: ("allow", "alias"), 4: ("block", "rule"),
            5: ("allow", "default"), 6: ("allow", "default"), None: ("allow", "default")}
    assert got() == want
    assert got(redirects=red) == want | {5: ("block", "alias"), 6: ("block", "alias")}
    assert {v for k, (v, _) in got(judge_targets=False).items() if k != 4} == {"allow"}
    assert op.judge_urls(d.limit(0)).count() == 0
    sql = ORACLE["op9_url_filter"]
    con = duckdb.connect()
    con.register("pages", d.toPandas())
    assert {r[0]: r[1] for r in con.sql(f"select page_id, verdict from ({sql})").fetchall() if r[0] is not None and r[0] == r[0]} == {
        k: v for k, (v, _) in want.items() if k is not None}
