"""Tables whose partitions are replaced by whole runs.

A run first stages its rows in a folder of its own version, which no reader sees, and then commits
them with one small file: the manifest rows that say which partitions this version now owns. Those
are the partitions the run was about, whether or not it found rows for them, and those it wrote.
So a rerun without rows leaves none of the old ones, and a run that is killed before its commit
changes nothing. Every attempt has a version of its own, so committed rows are never written over.
The last commit owns a partition; one writer commits at a time, and ties go by version.

    <path>/data/version=<version>/<partition columns>/...
    <path>/manifest/version=<version>/...
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folder(path: str, version: str) -> str:
    return f"{path}/data/version={version}"


def _read(spark: SparkSession, path: str, schema: T.StructType, version: str) -> DataFrame:
    """One version's rows, committed or not."""
    return spark.read.schema(schema).parquet(_folder(path, version)).select(*schema.names)


def fresh(name: str) -> str:
    """A version that no other attempt has."""
    return f"{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str, version: str, by: Sequence[str]) -> DataFrame:
    """Write ``df`` as an uncommitted version, which must be a fresh one, and return its stored rows.

    ``rebalance`` lets AQE merge small partitions and split large ones (a shop or day may hold a
    third of the rows), so files come out evenly sized without one task per shop.
    """
    df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(_folder(path, version))
    return _read(df.sparkSession, path, df.schema, version)


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """(number, schema, partition columns, version) of every commit; None before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    found = spark.read.option("mergeSchema", "true").parquet(f"{path}/manifest")
    return found.withColumn("version", F.col("version").cast("string"))


def commit(staged: DataFrame, path: str, version: str, by: Sequence[str], scope: DataFrame) -> None:
    """Let ``version`` own the partitions of ``scope`` and all that it has rows for.

    ``scope`` has the columns ``by``. Nothing changes before the manifest file is in place.
    """
    spark = staged.sparkSession
    known = manifest(spark, path)
    last = known.agg(F.max("number")).first()[0] if known is not None else 0
    columns = [F.col(c).cast(staged.schema[c].dataType) for c in by]
    owned = scope.select(*columns).union(staged.select(*columns)).distinct()
    rows = owned.select(F.lit(last + 1).cast("long").alias("number"), F.lit(staged.schema.json()).alias("schema"), *by)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={version}")


def replace(df: DataFrame, path: str, name: str, by: Sequence[str], scope: DataFrame) -> None:
    """Stage and commit a fresh version in one step."""
    version = fresh(name)
    commit(stage(df, path, version, by), path, version, by, scope)


def owners(spark: SparkSession, path: str) -> DataFrame | None:
    """The version that owns each partition: (partition columns, version)."""
    known = manifest(spark, path)
    if known is None:
        return None
    by = [c for c in known.columns if c not in ("number", "schema", "version")]
    return known.groupBy(*by).agg(F.max_by("version", F.struct("number", "version")).alias("version"))


def current(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table as of the last commit; only folders of versions that own something are listed."""
    live = owners(spark, path)
    if live is None:
        raise FileNotFoundError(f"no committed version below {path}")
    by = [c for c in live.columns if c != "version"]
    newest = manifest(spark, path).orderBy(F.desc("number"), F.desc("version")).first()
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    versions = [r[0] for r in live.select("version").distinct().collect()]  # of runs, not of rows
    full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[_folder(path, v) for v in sorted(versions)])
    mine = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*by, "version")])
    return rows.alias("r").join(live.alias("o"), mine, "left_semi").select(*schema.names)


def dead_versions(spark: SparkSession, path: str) -> DataFrame:
    """Committed versions that own nothing any more; their folders may be removed."""
    return manifest(spark, path).select("version").distinct().join(owners(spark, path), "version", "left_anti")
