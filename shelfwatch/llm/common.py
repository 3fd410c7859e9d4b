"""What several operators share: words, scratch tables, deterministic numbering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: white space between words, as a Java pattern and as the plain characters
GAP = r"[\x20\x09-\x0D]+"
BLANKS = "' \\t\\n\\u000b\\u000c\\r'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local master without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.gettempdir()}/llm-{spark.sparkContext.applicationId}"


def free_names(columns: Sequence[str], *wanted: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage; unlike a cached table it outlives any executor.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def map_slices(df: DataFrame, fields: str, column: str, make: Callable[[], Callable[[list], dict]], rows: int = 256) -> DataFrame:
    """``df`` with further columns ``fields`` (DDL), computed in Python from one column's values.

    ``make`` runs once per task and gives a function from a list of values to a list per field.
    Results leave the worker every ``rows`` rows, so it never holds more than one incoming batch.
    """
    added = T.StructType.fromDDL(fields)
    names, types = added.names, to_arrow_schema(added).types
    df = df.select(*[f"`{c}`" for c in df.columns if c not in names])  # as withColumn would replace them
    schema = T.StructType([*df.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                got = work(part.column(column).to_pylist())
                new = [pa.array(got[n], t) for n, t in zip(names, types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names])

    return df.mapInArrow(run, schema)


def words_sql(text: str) -> str:
    """SQL for the array of words of ``text``; none for null."""
    cut = f"btrim(coalesce({text}, ''), {BLANKS})"
    return rf"if({cut} = '', cast(array() as array<string>), split({cut}, '[\\x20\\x09-\\x0D]+'))"


def ranked(df: DataFrame, name: str, by: list[Column]) -> DataFrame:
    """Number all rows from 0 in the order ``by``, which must be unique: ranges, and their offsets.

    No task sees more than one range; only the ranges' row counts meet in one place.
    """
    ranged = materialise(df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*by)
    numbered = ranged.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    return numbered.join(offsets, "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def gapless(df: DataFrame, name: str, within: list[str], by: list[str], per_chunk: int = 50_000) -> DataFrame:
    """Number the rows of each ``within`` group from 0, by ``by`` inside hash chunks of the group.

    Each chunk holds about ``per_chunk`` rows, however large a group is, and is numbered by its
    own window; chunk counts, one row per chunk, add up to the offsets. ``df`` is read twice and
    must be stable. The order is deterministic but arbitrary across chunks.
    """
    chunk, rows, ahead = free_names([*df.columns, name], "_chunk", "_rows", "_before")
    sizes = df.groupBy(*within).agg(F.count(F.lit(1)).alias(rows))
    most = sizes.agg(F.max(rows)).first()[0] or 0
    chunks = most // per_chunk + 1
    marked = df.withColumn(chunk, F.pmod(F.xxhash64(*by), F.lit(chunks)))
    counts = marked.groupBy(*within, chunk).agg(F.count(F.lit(1)).alias(rows))
    before = Window.partitionBy(*within).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*within, chunk, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(ahead))
    inside = Window.partitionBy(*within, chunk).orderBy(*by)
    numbered = marked.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*within, chunk)]  # groups may have null keys
    both = numbered.alias("n").join(offsets.alias("o"), same)
    return both.select(*[F.col(f"n.`{c}`") for c in df.columns], (F.col(f"n.{name}") + F.col(f"o.{ahead}")).alias(name))
