"""Boilerplate lines of web pages by their frequency within the site.

A page's lines are its text between block-level tags. Within each host, the share of pages that hold a line tells
boilerplate (menus, notices) from content; lines above the ratio are dropped from every page of the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line on a larger share of its host's pages is boilerplate. It must stand on more than one page: on a host of less than five each line's share is above the ratio.
RATIO = 0.2
LEAST_PAGES = 2

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav"
    r"|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
TAG = r"<[^>]*>"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
BLANK = " \t\r\f\v"


def host(url: Column) -> Column:
    """The host of a URL in lower case; '' for NULL and for what has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def page_lines(html: Column) -> Column:
    """The lines of visible text, trimmed, without empty ones; none for NULL."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)))
    return F.filter(trimmed, lambda x: x != "")


def _key(line: Column) -> Column:
    """128 bits for the line, so that texts need not be shuffled."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host`` and ``lines``, the keys of its boilerplate lines, from the rows ``host``, ``keys``.

    A host of any size has at most its pages' mean number of lines divided by ``ratio`` such lines.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    lines = pages.select("host", F.explode(F.array_distinct("keys")).alias("key"))
    counts = lines.groupBy("host", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    often = counts.join(totals, "host").where(F.col("pages") > ratio * F.col("host_pages"))
    return often.groupBy("host").agg(F.collect_list("key").alias("lines"))


def site_lines(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per row ``page_id``, ``host``, ``n_lines``, ``n_dropped``, ``text`` (the lines kept).

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are ignored. Every row is a page, also one that repeats an id. Pages without
    a host are one site, ''. A line counts once for a page, and every copy of a dropped line goes.
    """
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), page_lines(F.col("html")).alias("all"))
    keyed = parsed.select("host", F.transform("all", _key).alias("keys"))
    joined = parsed.join(boilerplate(keyed, ratio, least_pages), "host", "left")
    kept = F.when(F.col("lines").isNull(), F.col("all")).otherwise(F.filter("all", lambda x: ~F.array_contains("lines", _key(x))))
    split = joined.select("page_id", "host", "all", kept.alias("kept"))
    return split.select("page_id", "host", F.size("all").cast("long").alias("n_lines"), (F.size("all") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
