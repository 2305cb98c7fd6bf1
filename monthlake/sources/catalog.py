"""Finding the newest file per period in crawled listing pages (as DataFrames).

Pages are rows ``(page_id, url, html)``; entries and their first link are pulled with regular
expressions (no DOM parser), filtered like the catalog search, and one version per period is
chosen by its ``Last-Modified`` time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.operators.dedup import latest_per_key

ENTRY_PATTERN = r"""(?is)<article\b[^>]*\bclass\s*=\s*["'][^"']*\bentry\b[^"']*["'][^>]*>(.*?)</article>"""
HREF_PATTERN = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)')"""
FILE_EXTENSIONS = (".csv", ".xlsx")


def extract_links(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The first link of every catalog entry (``article`` of class ``entry``): ``keep`` columns,
    ``pos`` (0-based order of the entry in the page), ``href``. Entries without a link are left
    out; both quote styles and any case are read."""
    entries = pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(ENTRY_PATTERN), 1))
                           .alias("pos", "entry"))
    href = F.concat(F.regexp_extract("entry", HREF_PATTERN, 1), F.regexp_extract("entry", HREF_PATTERN, 2))
    return entries.where(F.col("entry").rlike(HREF_PATTERN)).select(
        *keep, "pos", F.replace(href, F.lit("&amp;"), F.lit("&")).alias("href"))


def candidates(links: DataFrame, year: str | None, month_num: str | None, month_name: str | None,
               extensions: Sequence[str] = FILE_EXTENSIONS, href_col: str = "href") -> DataFrame:
    """Distinct links that are data files of the period.

    Kept when the lower-cased link contains one of ``extensions`` and either
    ``year + month_num`` or (``month_name`` and ``year``). Output keeps original case.
    """
    low = F.lower(F.col(href_col))
    is_file = F.lit(False)
    for ext in extensions:
        is_file = is_file | low.contains(ext.lower())
    by_num = low.contains(f"{year}{month_num}") if (year and month_num) else F.lit(False)
    by_name = (low.contains(month_name) & low.contains(year)) if (month_name and year) else F.lit(False)
    return links.where(is_file & (by_num | by_name)).select(href_col).distinct()


def latest_version(links: DataFrame, group: str | Sequence[str], modified: str, tie: str | Sequence[str]) -> DataFrame:
    """Per group, the link with the newest ``modified``; undated links only when no link
    of the group is dated; equal times -> first under ``tie``.

    A window top-1 (not ``max_by``, which yields NULL when every date is NULL)."""
    groups = [group] if isinstance(group, str) else list(group)
    ties = [tie] if isinstance(tie, str) else list(tie)
    return latest_per_key(links, groups, [F.col(modified).desc_nulls_last(), *ties])
