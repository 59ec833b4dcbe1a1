"""Text expressions: page HTML → visible text, trimming, reply fences."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from ..constants import DROPPED_ELEMENTS, FENCE_CLOSE, FENCE_OPEN, PROMPT_CHARS

# --- fixed values -----------------------------------------------------------
# Block-level tags whose boundaries become line breaks in the visible text.
BLOCK_TAGS = ("address", "article", "aside", "blockquote", "dd", "div", "dl", "dt", "fieldset",
              "figcaption", "figure", "form", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li",
              "main", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th",
              "thead", "tr", "ul")
# Named character references that the SQL check decodes (&amp; last); the full list is the standard library's.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))

# inside a tag: a quoted attribute value is part of it, whatever it holds (possessive, so no match is tried twice)
IN_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_RAW = [t for t in DROPPED_ELEMENTS if t in ("script", "style")]  # their content is text up to the end tag
_NESTED = [t for t in DROPPED_ELEMENTS if t not in (*_RAW, "img")]
BODY_RE = rf"(?is)<body\b{IN_TAG}>(.*?)(?:</body\s*>|\z)"
# what cuts a page into pieces: comments, raw elements (one that is never closed runs to the end), images and the
# tags of the elements that may be nested
CUT_RE = (r"(?is)<(?:!--.*?-->|" + "|".join(rf"{t}\b{IN_TAG}>.*?(?:</{t}\s*>|\z)" for t in _RAW)
          + rf"|img\b{IN_TAG}>|/?(?:{'|'.join(_NESTED)})\b{IN_TAG}>)")
BREAK_RE = r"(?i)<(?:br\s*/?|/?(?:" + "|".join(BLOCK_TAGS) + rf")\b{IN_TAG})>"
TAG_RE = rf"(?s)<(?:[A-Za-z/!?]{IN_TAG}>|[^>]*>)"


def page_body(html: Column) -> Column:
    """Inner HTML of <body>; pages missing </body> run to the end; no <body> → whole page."""
    return F.when(html.rlike(r"(?i)<body\b"), F.regexp_extract(html, BODY_RE, 1)).otherwise(html)


def without_dropped(html: Column) -> Column:
    """``html`` without comments, images and the dropped elements with their content.

    A fold over the cuts carries the open dropped element and its depth, so an element nested in one of its own
    name does not end it. An end tag without a start is ignored, an element that is never closed runs to the end; a
    self-closed ``svg`` is empty (other elements cannot be self-closed).
    """
    def step(acc: Column, c: Column) -> Column:
        opens = (acc["depth"] == 0) & (c["delta"] == 1)
        depth = F.when(acc["depth"] == 0, F.greatest(c["delta"], F.lit(0))).when(
            acc["name"] == c["name"], acc["depth"] + c["delta"]).otherwise(acc["depth"])
        return F.struct(F.when(opens, c["name"]).otherwise(acc["name"]).alias("name"), depth.alias("depth"),
                        F.concat(acc["kept"], F.when(depth == 0, "1").otherwise("0")).alias("kept"))

    def tag(c: Column) -> Column:
        name = F.lower(F.regexp_extract(c, r"^</?([A-Za-z]+)", 1))
        delta = F.when(~name.isin(*_NESTED) | ((name == "svg") & c.endswith("/>")), 0).when(c.startswith("</"), -1).otherwise(1)
        return F.struct(name.alias("name"), delta.alias("delta"))

    def walk(t: Column) -> Column:
        start = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit("1").alias("kept"))
        tags = F.transform(F.regexp_extract_all(t, F.lit(CUT_RE), F.lit(0)), tag)
        kept = F.aggregate(tags, start, step, lambda acc: acc["kept"])
        pieces = F.split(t, CUT_RE, -1)
        return F.array_join(let(kept, lambda k: F.filter(pieces, lambda p, i: F.substring(k, i + 1, F.lit(1)) == "1")), "")

    return let(html, walk)


REFERENCE_RE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD for what is none (0, surrogates, beyond Unicode)."""
    fine = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(fine, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def _decoded(ref: Column) -> Column:
    """One reference (``&…;``) decoded; an unknown name stays as it is."""
    body = F.substring(ref, 2, F.length(ref) - 2)
    names = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))])
    names = F.map_concat(names, F.create_map(F.lit("apos"), F.lit("'")))
    return (F.when(F.lower(F.left(body, F.lit(2))) == "#x",
                   _character(F.conv(F.substring(body, 3, 8), 16, 10).try_cast("int")))
            .when(F.left(body, F.lit(1)) == "#", _character(F.substring(body, 2, 8).try_cast("int")))
            .otherwise(F.coalesce(F.try_element_at(names, body), ref)))


def decode_entities(c: Column) -> Column:
    """Numeric and named character references (HTML 4 names and ``&apos;``), each decoded once; the distinct ones of
    a text are looked up once."""
    def walk(t):
        def joined(refs, known, rest):
            tail = F.zip_with(refs, F.slice(rest, F.lit(2), F.size(refs)), lambda ref, after: F.concat(
                F.element_at(known["char"], F.array_position(known["ref"], ref).cast("int")), after))
            return F.concat(F.element_at(rest, 1), F.array_join(tail, ""))

        def found(refs):
            distinct = let(F.array_distinct(refs), lambda d: F.struct(d.alias("ref"), F.transform(d, _decoded).alias("char")))
            return F.when(F.size(refs) > 0, let(distinct, lambda known: let(F.split(t, REFERENCE_RE, -1), lambda rest: joined(refs, known, rest)))).otherwise(t)

        return F.when(t.contains("&"), let(F.regexp_extract_all(t, F.lit(REFERENCE_RE), F.lit(0)), found)).otherwise(t)

    return let(c, walk)


def html_to_text(html: Column) -> Column:
    """Visible body text: drop script/style/noscript/svg/img/header/footer/nav (see ``without_dropped``),
    comments and tags; block tags and <br> become line breaks; runs of spaces
    collapse and blank lines are removed. The whole page is processed."""
    t = without_dropped(page_body(html))
    t = F.regexp_replace(t, BREAK_RE, "\n")
    t = F.regexp_replace(t, TAG_RE, "")
    t = decode_entities(t)
    t = F.regexp_replace(t, r"[ \t\r\f]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")


def py_strip(c: Column) -> Column:
    """Like Python's str.strip(): leading/trailing whitespace including newlines."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_fences(c: Column) -> Column:
    """Drop a leading ```json (7 chars) and, independently, a trailing ``` (3 chars)."""
    opened = F.when(c.startswith(FENCE_OPEN), F.substring(c, len(FENCE_OPEN) + 1, 1 << 30)).otherwise(c)
    return F.when(opened.endswith(FENCE_CLOSE), F.left(opened, F.length(opened) - len(FENCE_CLOSE))
                  ).otherwise(opened)


def text_segments(c: Column, n: int = PROMPT_CHARS) -> Column:
    """The text cut into consecutive pieces of ``n`` characters for the extraction model; nothing is dropped."""
    last = F.greatest(F.ceil(F.length(c) / F.lit(n)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(c, i * n + 1, F.lit(n)))
