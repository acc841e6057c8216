"""Links on listing pages, and the links not fetched yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anchor tags with an href, quoted or not (RE2 and Java agree on these).
HREF_PATTERN = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
QUOTES_PATTERN = r"""^["']|["']$"""
_ROOT = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)"


def extract_links(
    pages: DataFrame, html: str, keep: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per anchor href, optionally kept by a regex (searched, not
    anchored): (*carry, href). ``&amp;`` is decoded as an HTML parser would."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(HREF_PATTERN), F.lit(1))
    out = pages.select(*carry, F.explode(hrefs).alias("href")).withColumn(
        "href", F.replace(F.regexp_replace(F.col("href"), QUOTES_PATTERN, ""), F.lit("&amp;"), F.lit("&"))
    )
    if keep:
        out = out.filter(F.col("href").rlike(keep))
    return out


def resolve_links(base_url: Column, href: Column) -> Column:
    """Absolute URL: absolute hrefs as they are, root-relative hrefs on the
    page's scheme and host, other hrefs in the page's folder."""
    root = F.regexp_extract(base_url, _ROOT, 1)
    folder = F.regexp_extract(base_url, r"^([^?#]*/)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .otherwise(F.concat(folder, href))
    )


def new_files(candidates: DataFrame, stored: DataFrame, on: str) -> DataFrame:
    """Candidates whose ``on`` value is not stored yet (distinct).

    Both sides are reduced to distinct values before the anti-join, so a
    value listed on many pages is one row in the shuffle.
    """
    stored_keys = stored.select(F.col(on).alias("__stored")).distinct()
    return candidates.distinct().join(
        stored_keys, F.col(on) == F.col("__stored"), "left_anti"
    )
