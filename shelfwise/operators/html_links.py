"""Anchors of web pages, by Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An anchor and what it holds, up to its end tag, the next anchor or the end of the page.
ANCHOR = r"(?is)<a\s([^>]*)>(.*?)(?=</a\s*>|<a\s|$)"
#: Character references that links and their texts use.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in quotes or not; '' where it is missing."""
    pattern = rf"(?is)(?:^|\s){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return plain(F.concat(*(F.regexp_extract(tag, pattern, k) for k in (1, 2, 3))))


def plain(text: Column) -> Column:
    """Text with its common character references decoded."""
    for reference, character in REFERENCES.items():
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def _anchor(whole: Column) -> Column:
    inner = F.regexp_extract(whole, r"(?is)^<a\s[^>]*>(.*)$", 1)
    images = F.transform(F.regexp_extract_all(inner, F.lit(r"(?is)<img\s[^>]*>"), F.lit(0)), lambda tag: _attribute(tag, "src"))
    return F.struct(
        _attribute(F.regexp_extract(whole, r"(?is)^<a(\s[^>]*)>", 1), "href").alias("href"),
        plain(F.regexp_replace(inner, r"(?s)<[^>]*>", "")).alias("text"),
        F.coalesce(F.try_element_at(F.filter(images, lambda s: s != ""), F.lit(-1)), F.lit("")).alias("img"),
    )


def extract_anchors(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, pos from 1, href, text, img) of every anchor with an href; '' where it has no text or image.

    ``img`` is the source of the last image within the anchor that has one.
    Comments, scripts and styles hold no anchors.  Nothing shuffles.
    """
    visible = F.regexp_replace(F.col(html_col), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    anchors = F.transform(F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(0)), _anchor)
    rows = pages.select(F.col(id_col).alias("page_id"), F.posexplode(F.filter(anchors, lambda a: a["href"] != "")).alias("place", "a"))
    return rows.select("page_id", (F.col("place") + 1).alias("pos"), "a.href", "a.text", "a.img")
