"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL column names asset discovery looks for (any other
# column whose name ends in "_url" also counts).
URL_FIELDS = (
    "image_url", "thumbnail_url", "pdf_url", "attachment_url",
    "url", "file_url", "download_url", "media_url",
    "photo_url", "avatar_url", "icon_url",
)


def is_url_column(name: str) -> bool:
    return name in URL_FIELDS or name.endswith("_url")


def is_http(url: Column) -> Column:
    """F8: non-NULL text starting with ``http`` (case-sensitive)."""
    return url.isNotNull() & url.startswith("http")


def url_path(url: Column) -> Column:
    """The path part ('' when absent, NULL when not a URL)."""
    return F.try_parse_url(url, F.lit("PATH"))


def asset_path(url: Column, entity_type: Column) -> Column:
    """``<entity_type or 'unknown'>/<path without leading '/'>``; an empty
    path falls back to ``md5(url)``.  Host and query string are ignored."""
    path = F.ltrim(F.coalesce(url_path(url), F.lit("")), F.lit("/"))
    return F.concat(
        F.coalesce(F.nullif(entity_type, F.lit("")), F.lit("unknown")),
        F.lit("/"),
        F.coalesce(F.nullif(path, F.lit("")), F.md5(url)),
    )


def relative_path(url: Column, base_url: str) -> Column:
    """``url`` with ``base_url + '/'`` removed.  The base must be
    non-empty (an empty base would delete every '/')."""
    if not base_url:
        raise ValueError("base_url must be non-empty")
    return F.replace(url, F.lit(base_url.rstrip("/") + "/"), F.lit(""))
