"""Daily snapshot files: ``{SHOP}_{y}-{m}-{d}.csv``, one per shop and day, with drifting headers.

A CSV read maps columns by position, so files with different headers can't share one schema, and one
that allows line breaks in cells gives a file to one task. So all files are read once as lines, split
like any text; lines become records by the parity of their quotes, and records numbered cells. Each
file's header row then says which cell is which column. No file name passes through the driver. ``land`` stores new files by day and shop, so that
the history is read as Parquet afterwards.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwatch.functions.text import day_of
from shelfwatch.operators.quality import log_rows
from shelfwatch.schema import MINOR, SHOPS
from shelfwatch.sources import tables

# fixed values: columns of a snapshot file, and texts a CSV read takes for a missing value
COLUMNS = (
    "shop", "id", "reference", "name", "price", "inStock",
    "taxo1", "taxo2", "taxo3", "taxo4", "URL", "date",
)
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)
OLD_URL = "url_old"  # older files carry the link as ``url``


def by_shop_name(name: Column, shops: Sequence[str]) -> Column:
    out = F.lit(None).cast("string")
    for shop in reversed(shops):
        out = F.when(F.contains(name, F.lit(shop)), F.lit(shop)).otherwise(out)
    return out


def _lines(spark: SparkSession, root: str, shops: Sequence[str], pattern: str) -> DataFrame:
    """(src_shop, src_file, path, block, row, value) of every line; large files are read by many tasks."""
    rows = spark.read.schema("value string").text(f"{root.rstrip('/')}/{pattern}")
    path = F.col("_metadata.file_path")
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    file = F.when(F.endswith(folder, F.lit(".csv")), folder).otherwise(F.substring_index(path, "/", -1))
    lines = rows.select(
        file.alias("src_file"), path.alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value",
    )
    return (
        lines.withColumn("src_shop", by_shop_name(F.col("src_file"), shops))
        .where(F.col("src_shop").isNotNull() & ~F.contains("src_file", F.lit("before_clean")))
    )


def _records(lines: DataFrame) -> DataFrame:
    """Lines put together to records: a line break between an odd number of quotes ends none.

    Quotes are summed up within each block of a file (what one task reads), and over the blocks
    before it, one row each; so every line knows whether it starts a record. Only the lines of
    records over several lines meet in groups. A quote that is not closed within a block and the
    next one ends its record there: the lines of blocks in which no record starts are left out.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    inside = Window.partitionBy("path", "block").orderBy("row")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("path", "block").agg((F.sum(quotes) % 2).alias("_odd"))
    opened = blocks.select("path", "block", (F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2).alias("_open"))
    summed = lines.withColumns({"_quotes": quotes, "_sum": F.sum(quotes).over(upto)}).join(opened, ["path", "block"])
    at, after = (F.col("_open") + F.col("_sum") - F.col("_quotes")) % 2, (F.col("_open") + F.col("_sum")) % 2
    marked = summed.withColumns({"_starts": at == 0, "_ends": after == 0})
    single = marked.where("_starts and _ends")
    own = F.last(F.when(F.col("_starts"), F.col("row")), ignorenulls=True).over(upto)
    parts = marked.withColumn("_own", own).where("not (_starts and _ends)")
    # what continues at the head of a block was started by the last line of the block before it
    earlier = Window.partitionBy("path").orderBy("block")
    last = marked.groupBy("path", "block").agg(F.max(F.when(F.col("_starts"), F.col("row"))).alias("_last"))
    heads = last.select(
        "path", "block", F.lag("_last").over(earlier).alias("_head"), F.lag("block").over(earlier).alias("_head_block"), F.col("_last").alias("_any")
    )
    parts = parts.join(heads, ["path", "block"]).where("_own is not null or _any is not null or _head is not null")
    key = F.when(F.col("_own").isNotNull(), F.struct(F.col("block").alias("block"), F.col("_own").alias("row"))).otherwise(
        F.struct(F.col("_head_block").alias("block"), F.col("_head").alias("row"))
    )
    whole = (
        parts.withColumn("_key", key).where("_key.row is not null").groupBy("src_shop", "src_file", "path", "_key")
        .agg(F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("_lines"))
        .select("src_shop", "src_file", "path", "_key.block", "_key.row", F.array_join("_lines.value", "\n").alias("value"))
    )
    return single.select(*whole.columns).unionByName(whole)


def snapshot_cells(
    spark: SparkSession, root: str, shops: Sequence[str] = SHOPS, pattern: str = "*.csv", multi_line: bool = True
) -> DataFrame:
    """(src_shop, path, seq, cells) of all rows, header rows included, of the files below ``root``.

    A file counts if its name has the shop's name in it, ends in ``.csv`` and lacks
    ``before_clean``. A folder of that name, as Spark writes it, counts as one file. A quoted line
    break is part of its cell; with ``multi_line`` off, every line break ends a row. Large files are
    read by many tasks either way, and a row may have any number of cells. Cells with a quote in
    them are quoted as a whole, as CSV writers do.
    """
    lines = _lines(spark, root, shops, pattern)
    rows = (_records(lines) if multi_line else lines).where("value <> ''")
    cells = F.regexp_extract_all(F.concat(F.lit(","), "value"), F.lit(r',("(?:[^"]++|"")*+"|[^,]*+)'), F.lit(1))
    bare = F.transform(cells, lambda c: F.when(F.startswith(c, F.lit('"')), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(F.nullif(c, F.lit(""))))
    return rows.select(
        "src_shop", "path",
        F.struct("src_file", F.struct("path", "block").alias("src_block"), F.col("row").alias("src_row")).alias("seq"),
        bare.alias("cells"),
    )


def is_header(cells: Column) -> Column:
    """A header names at least these three columns in cells of their own."""
    named = F.array_contains(cells, "id") & F.array_contains(cells, "name") & F.array_contains(cells, "date")
    return F.coalesce(named, F.lit(False))


WANTED = (*COLUMNS, "url")


def _with_header(cells: DataFrame) -> DataFrame:
    """Rows with the column names of their file, and the cell of each wanted column (-1: not there)."""
    names = F.transform("h.cells", lambda c: F.regexp_replace(c, "^\ufeff", ""))
    places = F.array(*[F.array_position("names", F.lit(c)).cast("int") - 1 for c in WANTED])
    headers = (
        cells.where(is_header(F.col("cells"))).groupBy("path").agg(F.min(F.struct("seq", "cells")).alias("h"))
        .select("path", names.alias("names")).select("path", "names", places.alias("places"))
    )
    return cells.where(~is_header(F.col("cells"))).join(headers, "path")


TOO_WIDE = "more cells than columns"


def snapshot_rejects(
    spark: SparkSession, root: str, shops: Sequence[str] = SHOPS, pattern: str = "*.csv", multi_line: bool = True
) -> DataFrame:
    """Rows with more cells than their file has columns, as log rows."""
    wide = _with_header(snapshot_cells(spark, root, shops, pattern, multi_line)).where("size(cells) > size(names)")
    return log_rows(wide.withColumnRenamed("src_shop", "shop"), MINOR, F.lit(TOO_WIDE), "path")


def read_snapshots(
    spark: SparkSession, root: str, shops: Sequence[str] = SHOPS, pattern: str = "*.csv", multi_line: bool = True
) -> DataFrame:
    """All snapshot rows as text columns, matched by name over all header versions.

    ``seq`` orders rows as they lie in the files: file, block, row in the block. Files without a
    header give nothing, nor do rows with more cells than their header, see ``snapshot_rejects``.
    """
    rows = _with_header(snapshot_cells(spark, root, shops, pattern, multi_line)).where("size(cells) <= size(names)")

    def column(i: int) -> Column:
        value = F.get("cells", F.get("places", F.lit(i)))
        return F.when(~value.isin(list(MISSING)), value)

    texts = [column(i).alias(OLD_URL if c == "url" else c) for i, c in enumerate(WANTED)]
    return rows.select(*texts, "src_shop", "seq")


def land(spark: SparkSession, root: str, out: str, day: datetime.date | None = None, shops: Sequence[str] = SHOPS) -> None:
    """Store the files of one day (all if not given) as typed rows by day and shop.

    Only the day's files are listed and read, and its folders are written again.
    """
    pattern = "*.csv" if day is None else f"*_{day.year}-{day.month}-{day.day}.csv"
    typed = typed_snapshots(read_snapshots(spark, root, shops, pattern))
    dated = typed.withColumn("snapshot_date", day_of(F.col("date")))
    tables.write_partitioned(dated, out, "snapshot_date", "src_shop")


def typed_snapshots(raw: DataFrame) -> DataFrame:
    """Text columns to the record layout; unreadable values become null.

    Names of one shop's older files are wrapped like ``('NAME',)``; the wrapper is removed.
    """
    bare = F.regexp_extract("name", r"^\(['\"](.*)['\"],\)\z", 1)
    return raw.withColumns(
        {
            "name": F.when((F.col("src_shop") == "ZARA") & (bare != ""), bare).otherwise(F.col("name")),
            "price": F.col("price").try_cast("double"),
            "inStock": F.col("inStock").try_cast("boolean"),
        }
    )
