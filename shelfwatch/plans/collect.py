"""Collection: stored captures to raw and cleaned daily snapshots, all shops in one plan."""

from __future__ import annotations

import datetime
import hashlib
from dataclasses import dataclass
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfwatch.config.ladders import CATEGORY_LADDERS, KEEP_ALL_LISTINGS, PRODUCT_LADDERS
from shelfwatch.functions.levels import level_array
from shelfwatch.operators.dedup import first_category_wins, keep_first, with_rank
from shelfwatch.operators.quality import first_reason, log_rows, run_isolated
from shelfwatch.schema import CAPTURE, MAJOR, MEDIUM, MINOR, PRODUCT, RUN_LEDGER, RUN_LOG, SHOPS, TAXO, TIMING
from shelfwatch.session import stored
from shelfwatch.sources import payloads, tables, versions
from shelfwatch.sources.pages import CARDS, NO_CARDS, product_cards


@dataclass(frozen=True)
class Paths:
    """Where a run writes."""

    raw: str
    clean: str
    log: str
    ledger: str | None = None


def canonical(df: DataFrame) -> DataFrame:
    """The record layout plus ``seq``; every field is cast to its declared type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRODUCT], "seq")


NO_CATEGORY, NO_PAGE = "page of no listed category", "category without a page"


def captures_of(categories: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored pages with the levels of their category, and log rows of what found no partner.

    ``categories``: (shop, taxo1..4, url) of a category list; ``pages``: the columns of a capture
    without levels. A page of a URL that several categories share belongs to each of them. Pages
    are the side that a left join may split: a category that holds a third of them is read by many
    tasks, next to its one row.
    """
    listed = categories.select("shop", "url", *TAXO).distinct()
    rows = pages.drop(*TAXO).join(listed.withColumn("_listed", F.lit(True)), ["shop", "url"], "left").where("_listed")
    captures = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CAPTURE])
    urls = pages.select("shop", "url").distinct()
    stray = log_rows(urls.join(listed, ["shop", "url"], "left_anti"), MEDIUM, F.lit(NO_CATEGORY))
    empty = log_rows(listed.select("shop", "url").distinct().join(urls, ["shop", "url"], "left_anti"), MEDIUM, F.lit(NO_PAGE))
    return captures, stray.unionByName(empty)


def json_rows(captures: DataFrame) -> DataFrame:
    """Items of all JSON bodies with ``reason``, and one row per unreadable page: each body parsed once."""
    return payloads.flatten(captures)


def json_products(flat: DataFrame, filters: DataFrame | None = None) -> DataFrame:
    """Raw products of the shops that answer in JSON."""
    good = payloads.good_rows(flat)
    if filters is not None:
        good = payloads.with_sub_category(good, payloads.sub_categories(filters))
    # Categories own their products in the order they are visited, in one shop. Rows are stored by
    # shop, so the two branches read different folders and only this shop is shuffled.
    ours = F.col("shop") == "GAP"
    owned = first_category_wins(
        good.where(ours).withColumn("date", F.col("captured_at").cast("date")),
        CATEGORY_LADDERS,
        keys=("shop", "id", "date"),
        seq=("page_seq", "pos"),
    ).drop("date")
    rows = good.where(~ours).unionByName(owned)
    out = payloads.with_levels(rows).withColumns({"date": F.col("captured_at"), "seq": F.struct("page_seq", "pos")})
    return canonical(out.drop("url").withColumnRenamed("product_url", "URL"))


def card_rows(captures: DataFrame) -> DataFrame:
    """Cards of the shops whose pages are read card by card, with ``reason``; a row per page without any."""
    cards = product_cards(captures.withColumnRenamed("url", "page_url"), CARDS, "body")
    no_cards = F.col("pos").isNull()
    checks = [(no_cards, NO_CARDS), *[(F.col(c).isNull(), f"missing {c}") for c in ("id", "url")]]
    return cards.withColumn("reason", first_reason([*checks, (F.col("bad_price"), "price is not a number")]))


def card_products(cards: DataFrame) -> DataFrame:
    """Raw products of the cards without a reason against them."""
    levels = level_array([F.col(c) for c in TAXO[:3]], F.col("leaf"))
    good = cards.where(F.col("reason").isNull()).withColumn("_levels", levels)
    good = good.withColumns({c: F.get("_levels", F.lit(i)) for i, c in enumerate(TAXO)}).withColumns(
        {
            "reference": F.lit(None).cast("string"),
            "inStock": F.lit(True),
            "date": F.col("captured_at"),
            "seq": F.struct("page_seq", "pos"),
        }
    )
    return canonical(good)


def card_rejects(cards: DataFrame) -> DataFrame:
    bad = cards.where(F.col("reason").isNotNull())
    level = F.when(F.col("reason") == NO_CARDS, MEDIUM).otherwise(MINOR)
    return log_rows(bad, level, F.col("reason"), "page_url")


def collect(captures: DataFrame, filters: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw products, rejects) of all shops."""
    return products(json_rows(captures), card_rows(captures), filters), rejects(json_rows(captures), card_rows(captures))


def products(flat: DataFrame, cards: DataFrame, filters: DataFrame | None = None) -> DataFrame:
    return json_products(flat, filters).unionByName(card_products(cards))


def rejects(flat: DataFrame, cards: DataFrame) -> DataFrame:
    return payloads.rejects(flat).unionByName(card_rejects(cards))


def clean(raw: DataFrame, hm_dedup: bool = False) -> DataFrame:
    """Best listing per product, shop and day, in one pass over all shops.

    Shops with a ladder order by rank and four levels, the others by three levels. One shop keeps
    all listings: its rows are keyed by their own place in the source.
    """
    keep_all = F.lit(False) if hm_dedup else F.col("shop").isin(list(KEEP_ALL_LISTINGS))
    laddered = F.col("shop").isin(list(PRODUCT_LADDERS))
    named = raw.withColumn(
        "taxo3", F.when(F.col("shop") == "ASOS", F.coalesce("taxo3", F.lit("None"))).otherwise(F.col("taxo3"))
    )
    keyed = with_rank(named, PRODUCT_LADDERS, "_rank").withColumns(
        {
            "_day": F.col("date").cast("date"),
            "_own": F.when(keep_all, F.col("seq")),
            "_level4": F.when(laddered, F.col("taxo4")),
        }
    )
    first = keep_first(
        keyed,
        ["_day", "shop", "id", "reference", "name", "_own"],
        ["_rank", "taxo1", "taxo2", "taxo3", "_level4", "seq"],
    )
    return first.drop("_day", "_rank", "_own", "_level4")


def _per_shop(name: str) -> tuple[Observation, list]:
    """Row counts of every shop, taken while a plan runs."""
    return Observation(name), [F.count_if(F.col("shop") == s).alias(s) for s in SHOPS]


def _run(captures: DataFrame, paths: Paths, run: str, filters: DataFrame | None, shop: str | None = None) -> None:
    """Bodies are parsed once, into written rows that raw, log and clean are read from.

    Raw and cleaned rows are staged first and committed together at the end, so a run that fails
    on the way changes neither. The log and the ledger come last; those of a run over all shops
    also replace what runs of single shops had left. A single shop is timed by its caller.
    """
    spark, started, version = captures.sparkSession, _now(), versions.fresh(run)
    flat, cards = stored(json_rows(captures), "items"), stored(card_rows(captures), "cards")
    (raw_seen, counts), (clean_seen, _), (bad_seen, _) = (_per_shop(n) for n in ("raw", "clean", "bad"))
    raw = tables.stage_snapshot(products(flat, cards, filters).observe(raw_seen, *counts), paths.raw, version)
    best = tables.stage_snapshot(clean(raw.drop("snapshot_date")).observe(clean_seen, *counts), paths.clean, version)
    scope = stored(tables.snapshot_scope(captures), "scope")
    tables.commit_snapshot(raw, paths.raw, version, scope)
    tables.commit_snapshot(best, paths.clean, version, scope)
    ended = _now()
    shops, alone = ([shop], []) if shop else (SHOPS, [f"{run}-{s}" for s in SHOPS])
    log = rejects(flat, cards).observe(bad_seen, *counts)
    if not shop:
        timing = [(at, TIMING, s, event, None) for s in shops for at, event in ((started, "start"), (ended, "end"))]
        log = log.unionByName(spark.createDataFrame(timing, RUN_LOG))
    tables.write_log(log, paths.log, run, alone)
    if paths.ledger:
        seen = [_observed(o) for o in (raw_seen, clean_seen, bad_seen)]
        rows = [(s, started, ended, *[n.get(s, 0) for n in seen]) for s in shops]
        tables.write_log(spark.createDataFrame(rows, RUN_LEDGER), paths.ledger, run, alone)


def _observed(observation: Observation) -> dict[str, int]:
    """The counts; none where the optimizer found that there are no rows and left the step out."""
    try:
        return observation.get
    except Py4JJavaError as ex:
        if "AssertionError" not in str(ex.java_exception):
            raise
        return {}


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def run_name(captures: DataFrame) -> str:
    """The same name for every run about the same days and shops."""
    pairs = sorted((str(day), str(shop)) for day, shop in tables.snapshot_scope(captures).collect())  # days of one run
    return hashlib.sha256(repr(pairs).encode()).hexdigest()[:32]


def run(
    captures: DataFrame, raw_path: str, clean_path: str, log_path: str, filters: DataFrame | None = None,
    ledger_path: str | None = None, run: str | None = None,
) -> None:
    """Write raw snapshot, cleaned snapshot, log and ledger.

    The days and shops of the captures are replaced, also where nothing was found this time. The
    log says when each shop was started and done; the ledger also counts its rows. Both belong to
    the run of that name (by default one name per set of days and shops), and a rerun replaces
    them. All shops run in one plan. If it fails, each shop runs by itself: the one at fault is
    logged, the others are written.
    """
    paths, name = Paths(raw_path, clean_path, log_path, ledger_path), run or run_name(captures)
    try:
        _run(captures, paths, name, filters)
    except Exception:  # found out below, shop by shop
        jobs = {s: partial(_run, captures.where(F.col("shop") == s), paths, f"{name}-{s}", filters, s) for s in SHOPS}
        log = run_isolated(captures.sparkSession, jobs)
        failed = [f"{name}-{r.shop}" for r in log.where(F.col("level") == MAJOR).collect()]  # shops
        tables.write_log(log, log_path, name, failed)
        if ledger_path:
            tables.write_log(captures.sparkSession.createDataFrame([], RUN_LEDGER), ledger_path, name, failed)
