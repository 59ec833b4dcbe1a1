from hearth.llm import op4_html as op
from tests.llm.helpers import crowded, found

LONG = "the cat sat on the mat and it was by the door that led to the garden of the house in which they had been " * 3


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_article_parts_and_boilerplate():
    html = page(
        "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><header><h2>Site</h2></header>"
        "<div class=\"cookie-notice\">We use cookies on the site.</div><div id='ads'>Buy now</div>"
        "<article><h1>Title &amp; more</h1><p>Short one.<p><b>Bold</b>word &euro;&#8364;&#x20AC;<br>next\n\t line"
        "<div class='share-buttons'>Share</div><aside>Side</aside><form>Name <input></form>"
        "<table><tr><td>a</td><td>b</td></tr></table></article>"
        "<section id=comments><p>" + LONG + "</p></section><footer>&copy; x</footer>",
        "<style>p{}</style><script>var t='</p>';</script>")
    assert op.main_text(html) == "Title & more Short one. Boldword €€€ next line a b"


def test_density_rules_without_article():
    html = page("<div><a href=x>One</a> <a href=y>Two</a></div><h2>Head</h2><p>" + LONG + "</p><p>Tiny.</p><p>" + LONG +
                "</p><p>" + "zq xw kj " * 40 + "</p><div>Last</div>")
    want = " ".join(LONG.split())
    assert op.main_text(html) == f"Head {want} Tiny. {want}"


def test_unclosed_and_odd_markup():
    assert op.main_text("<article><p>a<!-- x --><p>b<script>if (a < b) {}") == "a b"
    assert op.main_text("<article><p>a<p>b<!-- never closed <p>c") == "a b"
    assert op.main_text("<main><p title=\"a>b\">x < y &amp &lt;i&gt;</p></main>") == "x < y & <i>"
    assert op.main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert op.main_text("") == op.main_text(None) == op.main_text("<p></p>") == ""


def test_dropped_elements_without_an_end_tag():
    for tag in ("<svg class='icon'/>", "<svg/>", "<math />", "<svg class='icon'>", "<video src=x>", "<object data='a>b'>",
                "<canvas>", "<audio>", "<noscript>", "<svg-icon>", "<video-player id=1>", "<svg title='>"):
        assert op.main_text(f"<article><p>A</p>{tag}<p>rest</p></article>") == "A rest", tag
        assert op.main_text(f"<article><p>A</p>{tag}<p>rest</p><svg><text>t</text></svg><p>end</p></article>") == "A rest end", tag
    inner = "<svg><text>x</text><svg><text>y</text></svg><svg/><text>z</text></svg>"
    assert op.main_text(f"<article><p>a</p>{inner}<p>b</p><noscript>n</noscript> c <textarea><textarea></textarea> d") == "a b c d"
    assert op.main_text("<article>" + "<svg><video>" * 20000 + "<p>deep</p></article>") == "deep"


def test_class_words_do_not_overrule_articles_or_prose():
    prose = " ".join(LONG.split())
    for start, end in (("<article class='post comments-open'>", "</article>"), ("<main class='has-sidebar'>", "</main>"),
                       ("<div id='content' class='no-sidebar'>", "</div>"), ("<div class='post sponsored'>", "</div>"),
                       ("<div class='page-with-sidebar'><main>", "</main></div>"), ("<article class='promo'>", "</article>"),
                       ("<div class='social'><main>", "</main></div>")):
        assert op.main_text(page(f"{start}<p>Short one.</p><p>{LONG}</p>{end}")) == f"Short one. {prose}", start
    for word in ("social", "search", "notice", "promotion", "related"):
        assert op.main_text(page(f"<article><p>A</p><section class='{word}'><p>{LONG}</p></section></article>")) == f"A {prose}", word
        assert op.main_text(page(f"<article><p>A</p><p class={word}>{LONG}</p><p>B</p></article>")) == f"A {prose} B", word
        assert op.main_text(page(f"<article><p>A</p><p class={word}>Share it</p><p>B</p></article>")) == "A B", word
    for start in ("<div class='comments'>", "<div class='post-comments'>", "<div class='main-ad'>", "<article class='comment'>",
                  "<nav class='content'>", "<div role=banner class=post>"):
        assert op.main_text(page(f"<article><p>A</p>{start}<p>{LONG}</p></article>")) == "A", start
    assert op.main_text(page(f"<div class='main-nav'>Short</div><p>{LONG}</p>")) == prose


def test_long_page_is_whole():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(2000))
    assert op.main_text(page(f"<article>{body}</article>")) == " ".join(" ".join(f"{LONG} {i}".split()) for i in range(2000))


def test_query_rows(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "u", "<article><p>é</p></article>"), (1, "u", "<article><p>é</p></article>"), (None, None, None), (2, "v", "")]
    d = crowded(spark.createDataFrame(rows, schema), "text", "n_chars")
    assert found(op.extract_main_text(d), "page_id", "text", "n_chars") == sorted(
        [(1, "é", 1), (1, "é", 1), (None, "", 0), (2, "", 0)], key=repr)
    assert op.extract_main_text(d.limit(0)).count() == 0


def test_articles_of_the_test_pages(spark):
    import html as lib
    import re

    from hearth.llm.common import read_table
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in op.extract_main_text(pages).collect():
        inner = re.search("<article>(.*?)</article>", raw[r["page_id"]], re.S)[1]
        want = " ".join(lib.unescape(re.sub("<[^>]+>", "", re.sub("</?(?:p|h1|br)>", " ", inner))).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_links_count_decoded_text_and_need_a_target():
    body = "the house of the street and the garden with a view to the river is for the family that was here with us as you see it"
    name = "caf\u00e9 \u00e9t\u00e9 r\u00e9sum\u00e9 na\u00efve \u00e0 la"
    refs = "".join(f"&#{ord(c)};" if ord(c) > 127 else c for c in name)
    for link in (name, refs):
        assert op.main_text(f"<body><p>{body} {body} <a href='/x'>{link}</a></p></body>") == f"{body} {body} {name}"
    for tag in ("<a name=x>", "<a id='y' class=z>", "<a>"):
        assert op.main_text(f"<body><div>{tag}{body} {body}</div></body>") == f"{body} {body}"
    assert op.main_text(f"<body><div><a href=/all>{body} {body}</a></div></body>") == ""


def test_wrappers_of_the_article_do_not_take_it():
    prose = " ".join(LONG.split())
    for start in ("<div class='wrap sidebar-right'><article>", "<div class='has-right-sidebar'><article>", "<div class=social><article>",
                  "<div id=nav-fixed><article>", "<div class='menu-left'><article>", "<div class='layout-sidebar'><div class=content>",
                  "<div class='blog-promo'><article>", "<article class='comments-list-off'>"):
        assert op.main_text(page(f"{start}<h1>Title</h1><p>Short one.</p><p>{LONG}</p>")) == f"Title Short one. {prose}", start
    cards = "<div class='related'><article><h3>Card</h3><p>Read on</p></article></div>"
    assert op.main_text(page(f"<article><h1>Title</h1><p>{LONG}</p></article>{cards}")) == f"Title {prose}"


class Plain:
    """The block rules a second time, over the tree of Python's own HTML parser, for pages whose tags are all closed."""

    def __init__(self, html):
        from html.parser import HTMLParser
        blocks, now = [], {"text": "", "links": 0}
        way = [{"tag": "", "level": 0, "scope": 0}]
        state = {"scopes": 0, "a": False, "heading": False, "raw": 0}

        def flush():
            text = " ".join(now["text"].split())
            if text:
                blocks.append({"text": text, "links": now["links"], "heading": state["heading"], **way[-1]})
            now.update(text="", links=0)

        class Walk(HTMLParser):
            def handle_starttag(self, tag, attrs):
                attrs = dict(attrs)
                if tag in ("script", "style"):
                    state["raw"] += 1
                elif tag == "a":
                    state["a"] = "href" in attrs
                elif tag != "b":
                    flush()
                    state["heading"] = tag in ("h1", "h2", "h3")
                    state["a"] = False
                    if tag != "br":
                        way.append(Plain.frame(tag, attrs, way[-1], state))

            def handle_endtag(self, tag):
                if tag in ("script", "style"):
                    state["raw"] -= 1
                elif tag == "a":
                    state["a"] = False
                elif tag != "b":
                    flush()
                    state["heading"] = state["a"] = False
                    way.pop()

            def handle_data(self, data):
                if not state["raw"]:
                    now["text"] += data
                    now["links"] += len("".join(data.split())) if state["a"] else 0

        walk = Walk(convert_charrefs=True)
        walk.feed(html)
        walk.close()
        flush()
        self.blocks = blocks

    @staticmethod
    def frame(tag, attrs, parent, state):
        import re
        inside = parent["scope"] > 0
        firm = tag in op.BAD_TAGS or (tag == "header" and not inside) or attrs.get("role") in op.BAD_ROLES
        article, soft, hard = tag in ("article", "main"), False, False
        for token in (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split():
            words = re.findall("[a-z0-9]+", token)
            bad = [w for i, w in enumerate(words) if (w in op.BAD_WORDS or (w in op.BAD_OUTSIDE and not inside))
                   and not any(x in op.STATE_BEFORE for x in words[:i]) and not any(x in op.STATE_AFTER for x in words[i + 1:])]
            hard = hard or any(w in op.FIRM_WORDS for w in bad)
            soft = soft or bool(bad)
            article = article or (not bad and any(w in op.ARTICLE_WORDS for w in words))
        counted = not article or (inside and hard)
        own = 2 if firm or (counted and hard) else 1 if counted and soft else 0
        above = parent["level"]
        article = article and own == 0
        if above == 1 and (tag == "main" or (article and state["scopes"] == 0)):
            above = 0
        scope = parent["scope"]
        if article and scope == 0 and above == 0:
            state["scopes"] += 1
            scope = state["scopes"]
        return {"tag": tag, "level": max(above, own), "scope": scope}

    @staticmethod
    def first(b):
        import re
        words = re.findall(r"[^\W\d_]+", b["text"].lower())
        stop = sum(w in op.STOP_WORDS for w in words) / max(1, len(words))
        n, linked = len(b["text"]), b["links"] > op.LINKS * len(b["text"])
        b["bad"] = b["level"] == 2 or (b["level"] == 1 and not (n >= op.LONG and not linked and stop >= op.STOP_HIGH))
        if b["bad"]:
            b["scope"] = 0
            return False
        if b["scope"]:
            return True if n >= op.SHORT and not linked else None
        if linked or (n < op.SHORT and b["links"]):
            return False
        if n < op.SHORT:
            return None
        return (True if n >= op.LONG else None) if stop >= op.STOP_HIGH else None if stop >= op.STOP_LOW else False

    def text(self):
        blocks = self.blocks
        labels = [self.first(b) for b in blocks]
        out = []
        for i, b in enumerate(blocks):
            good = labels[i]
            if good is None:
                same = [j for j, x in enumerate(blocks) if x["scope"] == b["scope"] and labels[j] is not None]
                left, right = max((j for j in same if j < i), default=None), min((j for j in same if j > i), default=None)
                edge = b["scope"] > 0
                before = edge if left is None else labels[left]
                after = edge if right is None else labels[right]
                far = len(blocks)
                d, e = far if left is None else i - left, far if right is None else right - i
                good = before if before == after or (d < e and not b["heading"]) else after if b["heading"] or e < d else False
            out += [b["text"]] * good
        return " ".join(out)


def random_page(rng):
    stop, other = ["the", "of", "and", "to", "in", "was", "la", "der"], ["house", "river", "&eacute;t&#233;", "x &lt; y", "qzx", "42"]

    def words(n, dense):
        return " ".join(rng.choice(stop if rng.random() < dense else other) for _ in range(n))

    def leaf():
        n, dense = rng.choice([1, 3, 12, 25, 60]), rng.choice([0.1, 0.25, 0.4, 0.6])
        kind = rng.randrange(6)
        if kind == 0:
            return f"<h2>{words(rng.randrange(1, 6), dense)}</h2>"
        if kind == 1:
            return "<ul>" + "".join(f"<li><a href='/{i}'>{words(3, dense)}</a></li>" for i in range(rng.randrange(1, 5))) + "</ul>"
        if kind == 2:
            return f"<p>{words(n, dense)} <a {rng.choice(['href=/x', 'name=y'])}>{words(rng.choice([1, 8, 40]), dense)}</a> {words(2, dense)}</p>"
        return f"<p>{words(n, dense)}<br>{words(rng.choice([1, 20]), dense)} <b>{words(2, dense)}</b></p>"

    def tree(depth):
        out = []
        for _ in range(rng.randrange(1, 5)):
            if depth and rng.random() < 0.5:
                tag = rng.choice("div div div section section article main nav aside header footer form".split())
                mark = rng.choice(["", "", " class='content'", " class='sidebar-right wrap'", " id=post-body", " class='comments'", " class='no-sidebar'",
                                   " class=related", " class='story open'", " class='ad'", " class='widget'", " role=banner", " class='post-comments-off'"])
                out.append(f"<{tag}{mark}>{tree(depth - 1)}</{tag}>")
            else:
                out.append(leaf())
        return rng.choice(["", "\n", "loose "]).join(out)

    return f"<html><head><title>T</title><style>p {{}}</style></head><body>{tree(4)}</body></html>"


def test_random_pages_against_a_plain_second_implementation():
    import random
    rng, texts = random.Random(17), 0
    for _ in range(1500):
        html = random_page(rng)
        got = op.main_text(html)
        assert got == Plain(html).text(), html
        texts += bool(got)
    assert texts > 600
