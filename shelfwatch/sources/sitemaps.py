"""XML sitemaps to URLs: stored bodies, one per row, and stored files of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions.text import strip
from shelfwatch.operators.quality import log_rows
from shelfwatch.schema import MEDIUM

NOT_READ = "not a sitemap"


def locations(body: Column, entry: str = "url") -> Column:
    """The ``loc`` of every entry, with or without a namespace; null if the body can't be read.

    Other elements named ``loc``, such as that of an image, are no entries.
    """
    parsed = F.from_xml(body, f"{entry} array<struct<loc:string>>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    return F.transform(parsed[entry], lambda e: e["loc"])


def sitemap_urls(sitemaps: DataFrame, body: str = "body", out: str = "loc", pos: str = "pos") -> DataFrame:
    """One row per entry with its position; unreadable bodies give none, see ``sitemap_rejects``."""
    return sitemaps.select(
        *[c for c in sitemaps.columns if c != body],
        F.posexplode(locations(F.col(body))).alias(pos, out),
    )


def sitemap_rejects(sitemaps: DataFrame, body: str = "body", url: str = "url", entry: str = "url") -> DataFrame:
    """Bodies without readable entries as log rows."""
    return log_rows(sitemaps.where(locations(F.col(body), entry).isNull()), MEDIUM, F.lit(NOT_READ), url)


def sitemap_of_index(index: DataFrame, sitemaps: DataFrame, wanted: str, body: str = "body") -> DataFrame:
    """Two levels: the first entry of the index that has ``wanted`` in it names the sitemap.

    ``index`` holds one index per shop; its entries are few (sitemap files, not pages).
    """
    first = F.filter(locations(F.col(body), "sitemap"), lambda u: F.contains(u, F.lit(wanted)))
    chosen = index.select("shop", F.get(first, F.lit(0)).alias("url"))
    return sitemap_urls(sitemaps.join(chosen, ["shop", "url"], "left_semi"), body)


def sitemap_entries(spark: SparkSession, path: str, entry: str = "url") -> tuple[DataFrame, DataFrame]:
    """(file, seq, loc) of every entry of the sitemap files below ``path``, and the files that end too early.

    The end of an entry separates the records of a text scan, so a large file is split over many
    tasks, inside a line too, and no task holds more than one entry. ``seq`` orders the entries of
    a file. A file whose root element is never closed is cut short: it has no entries, but a row in
    the second table.
    """
    schema = "value string"
    records = spark.read.schema(schema).option("lineSep", f"</{entry}>").option("recursiveFileLookup", "true").text(path)
    records = records.select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("seq"),
    )
    opening = rf"(?s)^.*<{entry}[\s>]"
    own = F.concat(F.lit(f"<{entry}>"), F.regexp_replace("value", opening, ""), F.lit(f"</{entry}>"))
    parsed = F.from_xml(own, "loc string", {"ignoreNamespace": "true", "rowTag": entry})
    starts = F.col("value").rlike(rf"<{entry}[\s>]")
    closed = F.col("value").rlike(r"</(?:urlset|sitemapindex)\s*>\s*$")
    cut = records.groupBy("file").agg(F.max(closed).alias("_closed")).where("not _closed").select("file")
    entries = records.where(starts).withColumn("loc", strip(parsed["loc"])).where("loc is not null")
    return entries.select("file", "seq", "loc").join(cut, "file", "left_anti"), cut


def two_levels(spark: SparkSession, index_path: str, sitemaps_path: str, wanted: str) -> tuple[DataFrame, DataFrame]:
    """Entries of the sitemap that the index names first among those with ``wanted`` in them, and files cut short.

    A sitemap is stored under the name that its URL ends with, as a file or as a folder of that
    name (with or without ``key=`` before it); an index names few of them.
    """
    index, bad_index = sitemap_entries(spark, index_path, "sitemap")
    entries, bad = sitemap_entries(spark, sitemaps_path)
    first = index.where(F.contains("loc", F.lit(wanted))).groupBy("file").agg(F.min_by("loc", "seq").alias("loc"))
    names = first.select(F.substring_index("loc", "/", -1).alias("_name")).distinct()
    parts = F.split("file", "/")
    folder, own = F.element_at(parts, -2), F.element_at(parts, -1)
    named = entries.withColumn("_name", F.when(F.startswith(own, F.lit("part-")), F.substring_index(folder, "=", -1)).otherwise(own))
    return named.join(names, "_name", "left_semi").drop("_name"), bad_index.union(bad)
