"""Record layouts shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

TAXO = ("taxo1", "taxo2", "taxo3", "taxo4")

PRODUCT = T.StructType(
    [
        T.StructField("shop", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("reference", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("inStock", T.BooleanType()),
        T.StructField("taxo1", T.StringType()),
        T.StructField("taxo2", T.StringType()),
        T.StructField("taxo3", T.StringType()),
        T.StructField("taxo4", T.StringType()),
        T.StructField("URL", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
    ]
)

# Stored response bodies, one row per fetched page, with the category and leaf (facet or link) that
# led to it. ``url`` is the category page, ``page_seq`` the order of fetching.
CAPTURE = T.StructType(
    [
        T.StructField("shop", T.StringType()),
        T.StructField("taxo1", T.StringType()),
        T.StructField("taxo2", T.StringType()),
        T.StructField("taxo3", T.StringType()),
        T.StructField("taxo4", T.StringType()),
        T.StructField("leaf", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("link_pos", T.LongType()),
        T.StructField("page_seq", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("captured_at", T.TimestampNTZType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("shop", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

# One row per run and shop: when it ran and how many rows it wrote or refused.
RUN_LEDGER = T.StructType(
    [
        T.StructField("shop", T.StringType()),
        T.StructField("started", T.TimestampType()),
        T.StructField("ended", T.TimestampType()),
        T.StructField("raw_rows", T.LongType()),
        T.StructField("clean_rows", T.LongType()),
        T.StructField("rejects", T.LongType()),
    ]
)

# Shops, log levels and the two genders that reach the combined table.
SHOPS = ("ASOS", "HM", "MS", "NEWLOOK", "PRIMARK", "TKMAXX", "ZARA", "GAP", "JOHN_LEWIS")
MAJOR = "MAJOR"
MEDIUM = "MEDIUM"
MINOR = "MINOR"
INFORMATION = "INFORMATION"
TIMING = "TIMING"
MAN = "MAN"
WOMAN = "WOMAN"
KID = "KID"
