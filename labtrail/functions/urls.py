"""Addresses of document-library folders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SITE = r"(?:^|/)sites/([^/]+)"


def _site_name(url: Column) -> Column:
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.nullif(F.regexp_extract(path, _SITE, 1), F.lit(""))


def url_site(url: Column) -> Column:
    """`host:/sites/<name>`, or null for an address without a site."""
    return F.concat(F.try_parse_url(url, F.lit("HOST")), F.lit(":/sites/"), _site_name(url))


def url_folder(url: Column) -> Column:
    """The folder named by the `id` argument, relative to its library; null without one.

    The argument is decoded twice: once as a query argument, once as a path, where `+` is a plain sign.
    """
    once = F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit("id")))
    full = F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))
    prefix = F.concat(F.lit("/sites/"), _site_name(url), F.lit("/"))
    inside = F.when(F.startswith(full, prefix), F.substr(full, F.length(prefix) + 1)).otherwise(full)
    slash = F.locate("/", inside)
    return F.when(_site_name(url).isNotNull() & (full != ""),
                  F.when(slash > 0, F.substr(inside, slash + 1)).otherwise(F.lit("")))
