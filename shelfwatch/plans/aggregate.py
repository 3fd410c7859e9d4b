"""Combined table: each shop's history mapped to the common taxonomy, in one pass over all shops."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.config.shops import AGGREGATED, Shop
from shelfwatch.functions.levels import below_root, lookup, shift_levels
from shelfwatch.operators.classify import class_of, classify, with_name_lc
from shelfwatch.operators.quality import duplicates, run_isolated
from shelfwatch.schema import MAN
from shelfwatch.sources import tables
from shelfwatch.sources.snapshots import OLD_URL, read_snapshots, typed_snapshots


def _case(shops: Sequence[Shop], trait: Callable, make: Callable, otherwise: Column) -> Column:
    """CASE over the shops with one branch per distinct trait, so shared rules appear once."""
    groups: dict = {}
    for shop in shops:
        value = trait(shop)
        if value:
            groups.setdefault(value, []).append(shop.name)
    out = None
    for value, names in groups.items():
        hit = F.col("src_shop").isin(names)
        out = F.when(hit, make(value)) if out is None else out.when(hit, make(value))
    return otherwise if out is None else out.otherwise(otherwise)


def unit_price(shops: Sequence[Shop] = AGGREGATED) -> Column:
    """Price in pounds; some shops' files have pence."""
    divisor = _case(shops, lambda s: s.price_divisor if s.price_divisor != 1 else None, F.lit, F.lit(1))
    return F.col("price") / divisor


def link() -> Column:
    """The link, which older files have in a column of another name."""
    return F.coalesce(OLD_URL, "URL")


def with_needed_name(df: DataFrame, shops: Sequence[Shop] = AGGREGATED) -> DataFrame:
    """Rows without a name leave where the shop's rules need one."""
    must_name = [s.name for s in shops if s.needs_name]
    return df.where(F.col("name").isNotNull() | ~F.col("src_shop").isin(must_name)) if must_name else df


def clean_shops(raw: DataFrame, shops: Sequence[Shop] = AGGREGATED) -> DataFrame:
    """Rows of the given shops in the common taxonomy; all roots but MAN and WOMAN leave.

    ``raw`` is a snapshot history with ``src_shop`` (the shop whose files a row came from), the
    old link column and ``seq``. The new ``seq`` puts men first, then rows of a shifted root, then
    source order: the order that later decides which row of a product and day counts.
    """
    names = [s.name for s in shops]
    df = raw.where(F.col("src_shop").isin(names))
    shifted = F.lit(False)
    for s in shops:
        if s.shift_root:
            shifted = shifted | ((F.col("src_shop") == s.name) & below_root(s.shift_root))
    df = shift_levels(df.withColumn("_shifted", shifted), F.col("_shifted"))
    genders = {f"{s.name}/{word}": g for s in shops for word, g in s.genders.items()}
    gender = F.col("taxo1")
    if genders:
        gender = F.coalesce(lookup(F.concat_ws("/", "src_shop", "taxo1"), genders), gender)
    df = with_needed_name(df, shops)
    men = _case(shops, lambda s: s.men, class_of, F.lit(""))
    women = _case(shops, lambda s: s.women, class_of, F.lit(""))
    df = classify(with_name_lc(df.withColumn("taxo1", gender)), men, women)
    return df.select(
        F.when(F.col("src_shop") == "MS", F.lit("MS")).otherwise(F.col("shop")).alias("shop"),
        "id",
        "reference",
        "name",
        unit_price(shops).alias("price"),
        "inStock",
        "taxo1",
        "taxo2",
        "taxo3",
        "taxo4",
        link().alias("URL"),
        "date",
        F.struct((F.col("taxo1") != MAN).alias("other"), (~F.col("_shifted")).alias("kept"), F.col("seq").alias("row")).alias("seq"),
    )


def run(spark: SparkSession, landing: str, out: str, shops: Sequence[Shop] = AGGREGATED, log_path: str | None = None) -> DataFrame:
    """Landing zone to the combined table; returns the duplicate (shop, id, date) notice.

    All shops run in one plan; if it fails, each by itself, and the failing ones are logged.
    """

    def one(some: Sequence[Shop]) -> None:
        raw = typed_snapshots(read_snapshots(spark, landing, [s.name for s in some]))
        names = [s.name for s in some]
        tables.write_aggregate(clean_shops(raw, some), out, "-".join(["aggregate", *names]), names)

    try:
        one(shops)
    except Exception:  # found out below, shop by shop
        log = run_isolated(spark, {s.name: partial(one, [s]) for s in shops})
        if log_path:
            tables.write_log(log, log_path, "aggregate")
    return duplicates(tables.read_table(spark, out))
