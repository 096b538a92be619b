"""Batches and folder addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.registry import query, table
from labtrail.functions import period_text
from labtrail.sources.batches import latest_batch, list_batches, newest_batches, source_prefix
from labtrail.sources.folders import folder_counts, url_sites

_BATCH = "event_type || '_' || strftime(ts, '%Y%m%d')"
_EVENTS = f"e AS (SELECT *, {_BATCH} AS batch_id FROM events)"


def batched(spark, sf_dir):
    """Events as batches: one per type and day, named like a saved extraction."""
    name = F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd"))
    return table(spark, sf_dir, "events").withColumn("batch_id", name)


@query("batch_list", f"WITH {_EVENTS} SELECT DISTINCT batch_id FROM e")
def batch_list(spark, sf_dir):
    return list_batches(batched(spark, sf_dir))


@query(
    "newest_batch",
    f"""
    WITH {_EVENTS}, m AS (SELECT event_type, max(batch_id) AS batch_id FROM e GROUP BY 1)
    SELECT event_id, event_type, batch_id, value FROM e SEMI JOIN m USING (event_type, batch_id)
    """,
)
def newest_batch(spark, sf_dir):
    """All rows of the newest batch of every source."""
    prefix = source_prefix(F.col("batch_id"))
    rows = latest_batch(batched(spark, sf_dir), by=[prefix])
    return rows.select("event_id", "event_type", "batch_id", "value")


@query(
    "newest_batch_before",
    f"""
    WITH {_EVENTS}
    SELECT event_type AS source, max(batch_id) AS batch_id FROM e
    WHERE batch_id < event_type || '_20240115' AND batch_id < 'view_20240115' GROUP BY 1
    """,
)
def newest_batch_before(spark, sf_dir):
    """Per source the newest batch strictly before the 15th."""
    rows = batched(spark, sf_dir)
    source = source_prefix(F.col("batch_id"))
    earlier = rows.where(F.col("batch_id") < F.concat(source, F.lit("_20240115")))
    return newest_batches(earlier, by=[source.alias("source")], before="view_20240115")


@query(
    "batch_periods",
    f"""
    WITH {_EVENTS}, p AS (SELECT event_type, min(ts) AS a, max(ts) AS b FROM e GROUP BY 1)
    SELECT event_type, strftime(a, '%d/%m/%Y') || ' a ' || strftime(b, '%d/%m/%Y') AS period, 'Nao disponivel' AS none FROM p
    """,
)
def batch_periods(spark, sf_dir):
    """The period a batch name states, and a name that states none."""
    spans = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.min("ts").alias("a"), F.max("ts").alias("b")
    )
    a, b = F.date_format("a", "yyyyMMdd"), F.date_format("b", "yyyyMMdd")
    named = F.concat("event_type", F.lit("_"), a, F.lit("_"), b, F.lit("_20240201_0700"))
    return spans.select(
        "event_type",
        period_text(named).alias("period"),
        period_text(F.concat("event_type", F.lit("_"), a, F.lit("_0700"))).alias("none"),
    )


# Page addresses rewritten as addresses of library folders.
def folder_urls(spark, sf_dir):
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    path = F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)
    lang = F.split_part(path, F.lit("/"), F.lit(1))
    inner = F.url_encode(F.concat(F.lit("/sites/"), lang, F.lit("/Documentos Compartilhados/"), path))
    folder = F.concat(
        F.lit("https://"), host, F.lit("/sites/"), lang, F.lit("/Forms/AllItems.aspx?id="), inner, F.lit("&p=1")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", F.when(F.contains("url", F.lit("ref=")), F.col("url")).otherwise(folder).alias("url")
    )


_FOLDERS = r"""
    p AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
                 regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages),
    f AS (SELECT page_id,
                 CASE WHEN url NOT LIKE '%ref=%' THEN host || ':/sites/' || split_part(path, '/', 1) END AS site,
                 CASE WHEN url NOT LIKE '%ref=%' THEN path END AS folder FROM p)
"""


@query("url_site_folder", f"WITH {_FOLDERS} SELECT page_id, site, folder FROM f")
def url_site_folder(spark, sf_dir):
    """Site and folder of each address; addresses that name neither get nulls."""
    return url_sites(folder_urls(spark, sf_dir)).drop("url")


@query(
    "site_folder_counts",
    f"WITH {_FOLDERS} SELECT site, count(*) AS n_urls, count(DISTINCT folder) AS n_folders FROM f GROUP BY site",
)
def site_folder_counts(spark, sf_dir):
    return folder_counts(folder_urls(spark, sf_dir))
