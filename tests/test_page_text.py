"""Visible text of pages with nested, quoted, self-closed and unclosed elements: by hand, against SQL and against a plain walk."""

import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearth.functions.text import html_to_text, without_dropped
from hearth.plans.oracle import PAGE_TEXT

CASES = [
    ("<header>a<header>b</header>LEAK</header>c", "c"),
    ("<p title='x>y'>z</p>", "z"),
    ('<p title="a>b" data-x=\'">\'>z</p>', "z"),
    ("<svg/><p>gone?</p><svg></svg>", "gone?"),
    ("<svg width='1'/>kept<svg><g><svg>in</svg></g>out</svg>end", "keptend"),
    ("a<nav>b<footer>c</nav>d</footer>e", "ad\ne".replace("\n", "")),
    ("</header>a</nav>b", "ab"),
    ("a<footer>never closed <p>b</p>", "a"),
    ("<script>if (a<b) '<header>'</script>x<style>nav > p {}</style>y", "xy"),
    ("<noscript><p>off</p></noscript>on", "on"),
    ("<img alt='a>b' src=x>text<img>more", "textmore"),
    ("a<!-- <header> -->b<!-- </header> -->c", "abc"),
    ("<HEADER>x</Header>y", "y"),
    ("<nav>one</nav><nav>two<nav>three</nav></nav>four<br/>five", "four\nfive"),
    ("<body data-x='>'><p>in</p></body><p>out</p>", "in"),
    ("<p>a &lt; b &amp;amp; c</p>", "a < b &amp; c"),
    ("", ""), ("<header></header>", ""), ("plain > text", "plain > text"),
]


def spark_text(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    return [r["t"] for r in df.select("i", html_to_text(F.col("h")).alias("t")).orderBy("i").collect()]


def sql_text(pages):
    con = duckdb.connect()
    con.register("p", pd.DataFrame({"page_id": range(len(pages)), "url": "u", "html": pages}))
    con.execute("create view pages as select * from p")
    return [r[0] for r in con.sql(f"with recursive {PAGE_TEXT} select text from texts order by page_id").fetchall()]


def test_cases_written_by_hand(spark):
    pages = [h for h, _ in CASES]
    assert spark_text(spark, pages) == [w for _, w in CASES]
    assert sql_text(pages) == [w for _, w in CASES]


def plain_walk(html):
    """Character by character, with a stack of one open dropped element."""
    out, name, depth, i = [], None, 0, 0
    tag = re.compile(r"""<(/?)([A-Za-z]+)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
    while i < len(html):
        if html.startswith("<!--", i) and "-->" in html[i + 4:]:
            i = html.index("-->", i + 4) + 3
            continue
        m = tag.match(html, i)
        if m:
            end, el, rest = m.group(1), m.group(2).lower(), m.group(3)
            if el in ("script", "style") and not end:
                close = re.compile(rf"</{el}\s*>", re.I).search(html, m.end())
                i = close.end() if close else len(html)
                continue
            if el == "img" and not end:
                i = m.end()
                continue
            if el in ("noscript", "svg", "header", "footer", "nav"):
                if not (el == "svg" and rest.endswith("/")):
                    if not depth:
                        if not end:
                            name, depth = el, 1
                    elif el == name:
                        depth += -1 if end else 1
                i = m.end()
                continue
        if not depth:
            out.append(html[i])
        i += 1
    return "".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_markup_against_a_plain_walk_and_sql(spark, seed):
    rng = random.Random(seed)
    parts = ["<header>", "</header>", "<nav class='a>b'>", "</nav>", "<svg/>", "<svg>", "</svg>", "<svg width=\"3\"/>", "<p>", "</p>", "word ",
             "x", "<img alt='>'>", "<!-- <nav> -->", "<script>a<nav>'</script>", "<style></nav></style>", "<footer>", "</footer >", "<br>", "&lt;",
             "<NAV>", "</NaV>", "<noscript>", "</noscript>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = [r["t"] for r in df.select("i", without_dropped(F.col("h")).alias("t")).orderBy("i").collect()]
    assert got == [plain_walk(h) for h in pages]
    assert spark_text(spark, pages) == sql_text(pages)


def test_long_pages_do_not_overflow(spark):
    """Long attributes, many cuts and many references: no stack overflow, and in reasonable time."""
    pages = ["<body><p title='" + "a>b" * 100_000 + "'>x</p>", "<p>" + "<img src='a'>y" * 20_000, "<nav>" * 3000 + "no" + "</nav>" * 3000 + "yes",
             "&eacute;&amp;&#8364;" * 30_000]
    got = spark_text(spark, pages)
    assert got[0] == "x" and got[1] == "y" * 20_000 and got[2] == "yes" and got[3] == "é&€" * 30_000
