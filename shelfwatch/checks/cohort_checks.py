"""Cohort queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from shelfwatch.checks.registry import query
from shelfwatch.checks.views import SNAP_SQL, snap, table
from shelfwatch.functions.text import day_of
from shelfwatch.operators import cohort as C

STOCKED = (
    "stocked AS (SELECT concat(shop, '_', id, '_') AS new_id, cast(date AS DATE) AS d, shop, taxo1, taxo2, taxo3, seq "
    "FROM snap WHERE in_stock)"
)
FIRST = "first_day AS (SELECT min(d) AS d0 FROM stocked)"
DAILY = (
    "daily AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY new_id, d ORDER BY seq) AS n FROM stocked) WHERE n = 1)"
)
IDS = "ids AS (SELECT DISTINCT new_id FROM stocked, first_day WHERE d = d0)"
NODES = (
    "nodes AS (SELECT daily.*, new_id IN (SELECT new_id FROM ids) AS is_old FROM daily "
    "WHERE taxo1 <> '' AND taxo2 <> '' AND taxo3 <> '')"
)
TOTALS = (
    "totals AS (SELECT shop, taxo1, taxo2, taxo3, count(*) AS total FROM nodes, first_day WHERE d = d0 GROUP BY ALL)"
)
VIEWS = (SNAP_SQL, STOCKED, FIRST, DAILY, IDS, NODES, TOTALS)


def stocked(spark, sf):
    return C.in_stock_days(snap(spark, sf), F.col("date").cast("date"), stock="in_stock")


@query(
    "cohort_new_old",
    """SELECT d AS date, n.shop, n.taxo1, n.taxo2, n.taxo3,
       nullif(count(*) FILTER (WHERE NOT is_old), 0) AS item_not_present_day1,
       nullif(count(*) FILTER (WHERE is_old), 0) AS item_present_day1,
       max(total) AS "Total_item_day_1"
    FROM nodes n CROSS JOIN first_day LEFT JOIN totals t
      ON n.shop = t.shop AND n.taxo1 = t.taxo1 AND n.taxo2 = t.taxo2 AND n.taxo3 = t.taxo3
    WHERE d > d0 GROUP BY 1, 2, 3, 4, 5""",
    VIEWS,
)
def cohort_new_old(spark, sf):
    return C.cohort_counts(stocked(spark, sf), until=datetime.date.max)


@query("day1_ids", "SELECT new_id FROM ids", VIEWS)
def day1_ids(spark, sf):
    return C.day1_ids(stocked(spark, sf))


@query(
    "day1_totals", 'SELECT shop, taxo1, taxo2, taxo3, total AS "Total_item_day_1" FROM totals', VIEWS
)
def day1_totals(spark, sf):
    return C.day1_totals(stocked(spark, sf))


_LATER = "SELECT new_id, d, shop, taxo1, taxo2, taxo3 FROM daily, first_day WHERE d > d0 AND new_id {} (SELECT new_id FROM ids)"


@query("cohort_old_semi", _LATER.format("IN"), VIEWS)
def cohort_old_semi(spark, sf):
    return C.split_by_day1(stocked(spark, sf))[0]


@query("cohort_new_anti", _LATER.format("NOT IN"), VIEWS)
def cohort_new_anti(spark, sf):
    return C.split_by_day1(stocked(spark, sf))[1]


@query(
    "cohort_outer",
    """SELECT d, shop, taxo1, taxo2, taxo3,
       nullif(count(*) FILTER (WHERE NOT is_old), 0) AS item_not_present_day1,
       nullif(count(*) FILTER (WHERE is_old), 0) AS item_present_day1
    FROM nodes, first_day WHERE d > d0 GROUP BY ALL""",
    VIEWS,
)
def cohort_outer(spark, sf):
    return C.cohort_outer(stocked(spark, sf))


_DAY_TEXT = (
    "CASE o_orderkey % 4 WHEN 0 THEN concat(cast(year(o_orderdate) as string), '-', cast(month(o_orderdate) as string), '-', "
    "cast(day(o_orderdate) as string), ' 07:12:03.120000') WHEN 1 THEN concat(cast(cast(o_orderdate as date) as string), ' 00:00:00') "
    "WHEN 2 THEN concat(cast(year(o_orderdate) as string), '-02-3', cast(o_orderkey % 8 as string)) ELSE o_orderpriority END"
)


@query(
    "parse_day",
    f"""SELECT o_orderkey, day_text, CASE WHEN regexp_full_match(split_part(day_text, ' ', 1), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
          THEN cast(try_strptime(split_part(day_text, ' ', 1), '%Y-%m-%d') AS DATE) END AS day
        FROM (SELECT o_orderkey, {_DAY_TEXT} AS day_text FROM orders)""",
)
def parse_day(spark, sf):
    return (
        table(spark, sf, "orders")
        .selectExpr("o_orderkey", f"{_DAY_TEXT} AS day_text")
        .withColumn("day", day_of(F.col("day_text")))
    )
