"""Folder addresses as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.functions import url_folder, url_site


def url_sites(df: DataFrame, url: str = "url") -> DataFrame:
    """Add `site` and `folder`; both are null for an address that names no site or no folder."""
    folder = url_folder(F.col(url))
    return df.withColumns(
        {"site": F.when(folder.isNotNull(), url_site(F.col(url))), "folder": folder}
    )


def folder_counts(df: DataFrame, url: str = "url") -> DataFrame:
    """Addresses and different folders per site."""
    return (
        url_sites(df, url)
        .groupBy("site")
        .agg(F.count("*").alias("n_urls"), F.count_distinct("folder").alias("n_folders"))
    )
