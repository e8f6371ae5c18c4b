"""Boilerplate lines by how often their own site repeats them.

A line is boilerplate on a host if more than ``ratio`` of the host's pages hold it, and at least ``min_pages`` of them.
The same line on another host is judged by that host's own pages. Pages and lines travel as 128-bit hashes; texts are
shuffled once, by page, so a host with a third of all pages is no larger task than any other.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Well below the share of rotating footers, adverts and menus on a large host (1 to 2 % of its pages each); on hosts of
#: up to 1,000 pages MIN_PAGES decides. The README has what other shares find and lose.
RATIO = 0.005
MIN_PAGES = 5

#: Elements that end a line of text, and those whose content is no text.
BLOCKS = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|"
    "hr|html|body|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)
#: One that is not closed goes on to the end of the page. No pattern reads a stretch of text more than once or twice.
UNSEEN = (
    r"(?is)<script[^<>]*>.*?(?:</script>|\z)",
    r"(?is)<style[^<>]*>.*?(?:</style>|\z)",
    r"(?s)<!--.*?(?:-->|\z)",
)
BLOCK_TAG = rf"</?(?:{BLOCKS})(?:[\s/][^<>]*)?>"
TAG = "<[^<>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """The host of a URL in small letters; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def lines_of_html(html: Column) -> Column:
    """The text of a page, a line for every block element, without tags, scripts, styles and comments.

    A tag lies between ``<`` and the next ``>`` and holds no other ``<``. The time is in proportion to the length of the page.
    """
    for pattern in UNSEEN:
        html = F.regexp_replace(html, pattern, "")
    return F.regexp_replace(F.regexp_replace(html, f"(?i){BLOCK_TAG}", "\n"), TAG, "")


def _pair(*values: Column) -> tuple[Column, Column]:
    """Two hashes with different seeds."""
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)


def _mark(line: Column) -> Column:
    a, b = _pair(F.trim(line))
    return F.struct(a.alias("a"), b.alias("b"))


def drop_boilerplate(
    pages: DataFrame, host: Column, key: str, text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """All columns of ``pages`` with ``text`` reduced to the kept lines, and ``n_lines`` and ``n_dropped`` beside them.

    Lines end at a line feed and are compared without the spaces around them; blank lines are neither counted nor
    dropped. A page counts once for a line, however often it holds it. A null host is the empty one; a null key is a key;
    a null text stays null, with no lines. Texts of any length are taken whole. An empty table stays empty. Repeated rows are a page each. A page may lose all its lines and
    stays, with an empty text. The table may have any further columns, also ``n_lines`` and ``n_dropped``, which are
    then replaced.
    """
    columns = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    frame = pages.select(F.struct(*columns).alias("row"), host.alias("host"))
    where = F.coalesce(F.col("host").cast("string"), F.lit(""))
    page_a, page_b = _pair(F.col(f"row.{key}"), where, F.col(f"row.{text}"))
    frame = frame.select("row", where.alias("host"), page_a.alias("page_a"), page_b.alias("page_b"))
    split = F.split(F.col(f"row.{text}"), "\n", -1)
    filled = F.filter(split, lambda x: F.trim(x) != "")
    lines = frame.select(
        "host", "page_a", "page_b", F.explode(F.array_distinct(F.transform(filled, _mark))).alias("line")
    ).select("host", "page_a", "page_b", "line.a", "line.b")

    totals = frame.groupBy("host").agg(F.count("*").alias("pages"))
    frequent = (
        lines.groupBy("host", "a", "b")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
        .join(totals, "host")
        .where(F.col("n") > ratio * F.col("pages"))
        .select("host", "a", "b")
    )
    found = (
        lines.join(frequent, ["host", "a", "b"])
        .groupBy("page_a", "page_b")
        .agg(F.collect_set(F.struct("a", "b")).alias("boilerplate"))
    )
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    judged = frame.join(found, ["page_a", "page_b"], "left").select(
        "row", split.alias("lines"), F.coalesce("boilerplate", none).alias("boilerplate")
    )
    kept = F.when(F.size("boilerplate") == 0, F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("boilerplate"), _mark(x)) | (F.trim(x) == ""))
    )
    judged = judged.select("row", "lines", kept.alias("kept"))
    filled_of = lambda name: F.size(F.filter(name, lambda x: F.trim(x) != ""))
    return judged.select(
        *(F.array_join("kept", "\n").alias(c) if c == text else F.col(f"row.`{c}`") for c in columns),
        F.coalesce(filled_of("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(filled_of("lines") - filled_of("kept"), F.lit(0)).cast("long").alias("n_dropped"),
    )
