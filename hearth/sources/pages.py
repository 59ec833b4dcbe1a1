"""Stored pages: the page frontier, visible text and the length gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_PAGE_CHARS, PROMPT_CHARS
from ..functions.binding import let
from ..functions.text import html_to_text, text_segments

DEFAULT_PAGES = 5


def base_url(url):
    """URL without query string and fragment."""
    return F.regexp_replace(url, r"[?#].*$", "")


def page_frontier(bases: DataFrame, num_pages: int = DEFAULT_PAGES, col: str = "base_url") -> DataFrame:
    """Page 1 is the base URL itself, page n is ``base?page=n``."""
    n = F.col("page_no")
    return (bases.select(F.col(col).alias("base_url"),
                         F.explode(F.sequence(F.lit(1), F.lit(num_pages))).alias("page_no"))
            .select("base_url", n.cast("int").alias("page_no"),
                    F.when(n == 1, F.col("base_url"))
                     .otherwise(F.concat(F.col("base_url"), F.lit("?page="), n.cast("string"))).alias("url")))


def frontier_from_pages(pages: DataFrame, num_pages: int = DEFAULT_PAGES) -> DataFrame:
    bases = pages.select(base_url(F.col("url")).alias("base_url")).distinct()
    return page_frontier(bases, num_pages)


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) from the whole HTML of every page."""
    t = html_to_text(F.col("html"))
    return (pages.select("page_id", "url", t.alias("text"))
            .withColumn("n_chars", F.length("text").cast("int")))


def gate_pages(pages: DataFrame, min_chars: int = MIN_PAGE_CHARS, segment_chars: int = PROMPT_CHARS) -> DataFrame:
    """Pages whose text is long enough to extract from, as model inputs: one row per consecutive segment of
    ``segment_chars`` characters (page_id, n_chars, segment_no, prompt_text, prompt_chars).

    Filter and projection happen in one generator (``inline`` of an array that is empty for short
    pages), so the text of a page is computed once: a Filter on the text length would be pushed
    below the projection and repeat it.
    """
    def keep(t):
        n = F.length(t).cast("int")
        rows = F.transform(text_segments(t, segment_chars), lambda x, i: F.struct(
            n.alias("n_chars"), (i + 1).cast("int").alias("segment_no"), x.alias("prompt_text"),
            F.length(x).cast("int").alias("prompt_chars")))
        return F.when(n >= min_chars, rows).otherwise(F.array().cast(
            "array<struct<n_chars:int,segment_no:int,prompt_text:string,prompt_chars:int>>"))

    g = let(html_to_text(F.col("html")), keep)
    return pages.select("page_id", F.inline(g))
