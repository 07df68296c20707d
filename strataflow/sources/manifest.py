"""Which source files exist and which are new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.incremental import new_keys


def parse_listing(pages: DataFrame, xml: str = "xml", page: str = "page") -> DataFrame:
    """Keys of an XML bucket listing, in listing order: ``(page, pos, key)``.

    A listing of many pages is parsed page by page, in parallel.
    """
    found = F.posexplode(F.xpath(F.col(xml), F.lit("//Key/text()"))).alias("pos", "key")
    return pages.select(F.col(page).alias("page"), found)


def slice_listing(keys: DataFrame, prefix: str, suffix: str, start_from: str) -> DataFrame:
    """Keys with the prefix and suffix, from ``start_from`` on, in listing order.

    An empty ``start_from`` takes all.  If it is not listed the result is empty;
    ``start_listed`` tells that from nothing new.
    """
    wanted = keys.where(F.col("key").startswith(prefix) & F.col("key").endswith(suffix))
    if not start_from:
        return wanted
    place = F.struct("page", "pos")
    start = wanted.where(F.col("key") == start_from).agg(F.min(place)).scalar()
    return wanted.where(place >= start)


def start_listed(keys: DataFrame, start_from: str) -> bool:
    """Whether the key to start from is in the listing; an empty one always is."""
    return not start_from or not keys.where(F.col("key") == start_from).isEmpty()


def discover_sources(
    pages: DataFrame,
    prefix: str,
    suffix: str,
    start_from: str,
    xml: str = "xml",
    page: str = "page",
) -> DataFrame:
    """Source keys to work on, as ``(page, pos, key)``; order by the first two."""
    return slice_listing(parse_listing(pages, xml, page), prefix, suffix, start_from)


def new_sources(manifest: DataFrame, landed: DataFrame | None, key: str = "key") -> DataFrame:
    """Manifest keys that have not landed yet."""
    return new_keys(landed, manifest, key)
