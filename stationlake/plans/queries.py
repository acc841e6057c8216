"""Every operator as a query over the driver tables, with its oracle SQL.

The observation files themselves are not part of the test data, so each
operator also runs on the given tables (``sf_dir/<table>.parquet``): events
stand in for measurements and for the two station histories, lineitem for
duplicated keys and codes, orders for station-years and the partitioned
table, documents for sectioned text and archive bodies, pages for listing
pages. Every query reads whole tables; none caps, samples or subsets ids.

``QUERIES[name]`` is ``(spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the
same result in DuckDB SQL over views of the same tables (absent where the
query writes files first).
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import (
    PAYMENT_TYPE_LABELS,
    cast_int_rounded,
    clean_station_id,
    concat_nullable,
    decode_codes,
    localize,
    local_year,
    null_sentinel,
    obs_date,
    parse_yyyymmdd,
    surrogate_key,
    year_month,
)
from ..operators import (
    Check,
    check_accepted_values,
    check_not_null,
    check_relationships,
    check_unique,
    distinct_values,
    effective_dated_join,
    global_max,
    group_max,
    intervals_from_starts,
    keep_first,
    local_day_slice,
    quality_report,
    spread,
    time_slice,
    top_k,
    total_order,
    union_categories,
    write_ordered,
)
from ..schemas import OPERATOR_MARKER, PRECIPITATION_FORMS, QUALITY_LEVELS
from ..session import at_once, materialize, materialize_counted, shared_dir
from ..operators.sweep import sweep_join
from ..sinks import publish_table, write_partitioned
from ..sources import (
    Ledger,
    explode_archives,
    extract_links,
    new_files,
    read_delimited,
    read_delimited_checked,
    read_sectioned,
    route_members,
    section_lines,
)
from ..sources.tables import read_parquet, read_table
from . import weather
from .derived import PLAIN, RICH, RICH_GEO_VALUE, Variant, write_raw_from_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LINEITEM_COLS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

# ---------------------------------------------------------------------------
# One row per key
# ---------------------------------------------------------------------------


@query(
    "dedup_latest",
    f"""
SELECT {LINEITEM_COLS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST,
             l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST, l_discount ASC NULLS FIRST,
             l_tax ASC NULLS FIRST, l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST) AS _rn
  FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
) WHERE _rn = 1
""",
)
def dedup_latest(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return keep_first(li, keys, total_order(li, keys, first=[("l_shipdate", True)]))


# ---------------------------------------------------------------------------
# Effective-dated fact
# ---------------------------------------------------------------------------


def event_histories(spark, sf_dir, touching: bool):
    """Two per-user histories from the events: 'signup' events open a new
    location interval, 'error' events a new operator interval. Both are
    built in one job (keyed by user and kind) and written once."""
    ev = table(spark, sf_dir, "events")
    starts = ev.filter(F.col("event_type").isin("signup", "error")).select(
        "user_id", F.col("event_type").alias("kind"), "ts", "event_id", "value"
    )
    # Buckets fine enough for the data's time span (events span about a
    # month: minutes, so a user holding a third of the rows is ~43,000 cells).
    both, counts = materialize_counted(
        intervals_from_starts(
            starts,
            ["user_id", "kind"],
            "ts",
            touching=touching,
            bucket="auto",
            extra=["event_id", "value"],
            tiebreak=["event_id"],
        ),
        "event_histories",
        signup=F.count_if(F.col("kind") == "signup"),
        error=F.count_if(F.col("kind") == "error"),
    )

    def kind(name: str, prefix: str) -> DataFrame:
        return both.filter(F.col("kind") == name).select(
            "user_id",
            F.col("event_id").alias(f"{prefix}_event_id"),
            F.col("value").alias(f"{prefix}_value"),
            F.col("start").alias(f"{prefix}_start"),
            F.col("end").alias(f"{prefix}_end"),
        )

    return ev, (kind("signup", "geo"), counts["signup"]), (kind("error", "op"), counts["error"])


def effective_fact(spark, sf_dir, touching: bool, max_broadcast_rows=None):
    ev, (geo, geo_rows), (op, op_rows) = event_histories(spark, sf_dir, touching)
    kw = {"materialize_dim": False}
    if max_broadcast_rows is not None:
        kw["max_broadcast_rows"] = max_broadcast_rows
    fact = ev.select("event_id", "user_id", "ts", "event_type")
    fact = effective_dated_join(fact, geo, "user_id", "ts", "geo_start", "geo_end", dim_rows=geo_rows, **kw)
    fact = effective_dated_join(fact, op, "user_id", "ts", "op_start", "op_end", dim_rows=op_rows, **kw)
    return fact.select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        "geo_event_id",
        "geo_value",
        "op_event_id",
        "op_value",
        concat_nullable(F.col("geo_value").cast("string"), F.col("op_value").cast("string")).alias(
            "lat_long"
        ),
    )


def _fact_sql(end_expr: str) -> str:
    return f"""
WITH geo AS (
  SELECT user_id, event_id AS geo_event_id, value AS geo_value, ts AS geo_start,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id){end_expr} AS geo_end
  FROM events WHERE event_type = 'signup'
), op AS (
  SELECT user_id, event_id AS op_event_id, value AS op_value, ts AS op_start,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id){end_expr} AS op_end
  FROM events WHERE event_type = 'error'
)
SELECT e.event_id, e.user_id, e.ts, e.event_type,
       g.geo_event_id, g.geo_value, o.op_event_id, o.op_value,
       CAST(g.geo_value AS VARCHAR) || ',' || CAST(o.op_value AS VARCHAR) AS lat_long
FROM events e
LEFT JOIN geo g
  ON e.user_id = g.user_id AND e.ts >= g.geo_start AND (g.geo_end IS NULL OR e.ts <= g.geo_end)
LEFT JOIN op o
  ON e.user_id = o.user_id AND e.ts >= o.op_start AND (o.op_end IS NULL OR e.ts <= o.op_end)
"""


@query("effective_dated_fact", _fact_sql(" - INTERVAL 1 MICROSECOND"))
def effective_dated_fact(spark, sf_dir):
    return effective_fact(spark, sf_dir, touching=False)


@query("effective_dated_overlap", _fact_sql(""))
def effective_dated_overlap(spark, sf_dir):
    return effective_fact(spark, sf_dir, touching=True)


@query(
    "hot_key_intervals",
    """
WITH open AS (
  SELECT event_id AS geo_event_id, value AS geo_value, ts AS geo_start, ts + INTERVAL 1 HOUR AS geo_end
  FROM events WHERE event_type = 'signup'
)
SELECT e.event_id, count(o.geo_event_id) AS n_open, min(o.geo_event_id) AS first_open,
       CAST(sum(o.geo_event_id) AS BIGINT) AS sum_open
FROM events e LEFT JOIN open o ON e.ts >= o.geo_start AND e.ts <= o.geo_end
GROUP BY e.event_id
""",
)
def hot_key_intervals(spark, sf_dir):
    """All events and all intervals under one key, the intervals overlapping:
    what is open at each event, by the sweep, which keeps count, sum and least id
    as intervals open and end: pairs would grow with the square of the events."""
    ev = table(spark, sf_dir, "events").withColumn("station", F.lit(1))
    spans = ev.filter(F.col("event_type") == "signup").select(
        "station",
        F.col("event_id").alias("geo_event_id"),
        F.col("ts").alias("geo_start"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("geo_end"),
    )
    found = sweep_join(
        ev.select("station", "event_id", "ts"),
        spans,
        "station",
        "ts",
        "geo_start",
        "geo_end",
        combine={k: (k, "geo_event_id") for k in ("count", "min", "sum")},
    )
    # An id may be repeated.
    return found.groupBy("event_id").agg(
        F.sum("count").alias("n_open"), F.min("min").alias("first_open"), F.sum("sum").alias("sum_open")
    )


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------


@query(
    "surrogate_key",
    """
SELECT l_orderkey, l_linenumber,
       md5(concat_ws('-',
         coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
         coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS measurement_id
FROM lineitem
""",
)
def surrogate_key_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", surrogate_key(li, ["l_orderkey", "l_linenumber"]).alias("measurement_id")
    )


@query(
    "localize_midnight",
    """
SELECT event_id,
       date_trunc('day', ts) AS local_midnight,
       (date_trunc('day', ts) AT TIME ZONE 'Europe/Brussels') AT TIME ZONE 'UTC' AS utc_midnight,
       strftime(date_trunc('day', ts), '%Y') AS year
FROM events
""",
)
def localize_midnight(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    local = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    return ev.select(
        "event_id",
        local.alias("local_midnight"),
        localize(local).alias("utc_midnight"),
        local_year(local).alias("year"),
    )


@query(
    "pad_ids",
    """
SELECT o_orderkey, raw_id,
       CASE WHEN length(replace(raw_id, ' ', '')) < 5
            THEN lpad(replace(raw_id, ' ', ''), 5, '0')
            ELSE replace(raw_id, ' ', '') END AS station_id
FROM (SELECT o_orderkey, '  ' || CAST(o_orderkey * 100 AS VARCHAR) AS raw_id FROM orders)
""",
)
def pad_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = F.concat(F.lit("  "), (F.col("o_orderkey") * 100).cast("string"))
    return o.select("o_orderkey", raw.alias("raw_id")).withColumn("station_id", clean_station_id("raw_id"))


@query(
    "round_and_int",
    """
SELECT event_id, round(value, 1) AS value_1, CAST(round(value) AS INTEGER) AS value_int
FROM events
""",
)
def round_and_int(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", F.round("value", 1).alias("value_1"), cast_int_rounded("value").alias("value_int")
    )


@query(
    "parse_dates",
    """
SELECT l_orderkey, l_linenumber, raw_date,
       CAST(try_strptime(raw_date, '%Y%m%d') AS TIMESTAMP) AS parsed
FROM (SELECT l_orderkey, l_linenumber, '202402' || CAST(l_linenumber + 25 AS VARCHAR) AS raw_date
      FROM lineitem)
""",
)
def parse_dates(spark, sf_dir):
    li = spread(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    raw = F.concat(F.lit("202402"), (F.col("l_linenumber") + 25).cast("string"))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw_date")).withColumn(
        "parsed", parse_yyyymmdd("raw_date")
    )


@query(
    "decode_codes",
    f"""
SELECT l_linenumber,
       CASE l_linenumber {" ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENT_TYPE_LABELS.items())} END AS label,
       count(*) AS n_rows
FROM lineitem GROUP BY 1, 2
""",
)
def decode_codes_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_linenumber", decode_codes("l_linenumber").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "sentinel_to_null",
    """
SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS l_discount FROM lineitem
""",
)
def sentinel_to_null(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", null_sentinel("l_discount", 0.0).alias("l_discount"))


# ---------------------------------------------------------------------------
# Aggregations, sorts, slices
# ---------------------------------------------------------------------------


@query(
    "station_year_max",
    """
SELECT o_custkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS order_year,
       max(o_totalprice) AS max_totalprice
FROM orders GROUP BY 1, 2
""",
)
def station_year_max(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return group_max(o, ["o_custkey", F.year("o_orderdate").alias("order_year")], "o_totalprice", "max_totalprice")


@query(
    "distinct_years",
    """
SELECT DISTINCT CAST(extract(year FROM o_orderdate) AS INTEGER) AS order_year
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01'
""",
)
def distinct_years(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter(F.to_date("o_orderdate") >= F.lit("1996-01-01").cast("date"))
    return distinct_values(o, F.year("o_orderdate"), "order_year")


@query("global_max", "SELECT max(ts) AS max_ts FROM events")
def global_max_q(spark, sf_dir):
    return global_max(table(spark, sf_dir, "events"), "ts", "max_ts")


@query(
    "topk",
    "SELECT event_id, value FROM events ORDER BY value DESC, event_id ASC LIMIT 40",
)
def topk(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return top_k(ev, 40, [F.col("value").desc(), F.col("event_id").asc()])


@query(
    "time_slice",
    """
SELECT * FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
""",
)
def time_slice_q(spark, sf_dir):
    return time_slice(table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-20")


@query(
    "union_categories",
    """
SELECT *, 'recent' AS category FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL
SELECT *, 'historical' AS category FROM events WHERE ts < TIMESTAMP '2024-01-18 00:00:00'
""",
)
def union_categories_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return union_categories(
        {
            "recent": ev.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")),
            "historical": ev.filter(F.col("ts") < F.lit("2024-01-18").cast("timestamp_ntz")),
        }
    )


# ---------------------------------------------------------------------------
# Q1-Q5: quality checks
# ---------------------------------------------------------------------------


@query(
    "check_unique",
    """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1
""",
)
def check_unique_q(spark, sf_dir):
    return check_unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


def _valid_orders(spark, sf_dir):
    # Pending orders are not yet valid parents.
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")


@query(
    "check_relationships",
    """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem l
WHERE l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = l.l_orderkey)
GROUP BY l_orderkey
""",
)
def check_relationships_q(spark, sf_dir):
    return check_relationships(table(spark, sf_dir, "lineitem"), "l_orderkey", _valid_orders(spark, sf_dir), "o_orderkey")


@query(
    "check_accepted_values",
    """
SELECT event_type, count(*) AS n_rows FROM events
WHERE event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase')
GROUP BY event_type
""",
)
def check_accepted_values_q(spark, sf_dir):
    return check_accepted_values(table(spark, sf_dir, "events"), "event_type", ["click", "view", "purchase"])


@query(
    "check_not_null",
    """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE nullif(l_discount, 0.0) IS NULL
""",
)
def check_not_null_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("l_discount", null_sentinel("l_discount", 0.0))
    return check_not_null(li, "l_discount").select("l_orderkey", "l_linenumber")


@query(
    "quality_report",
    """
WITH r AS (
  SELECT 'unique' AS check_name, 'lineitem.l_orderkey' AS column_name, 'warn' AS severity,
         (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL
                                GROUP BY 1 HAVING count(*) > 1)) AS failures
  UNION ALL
  SELECT 'not_null', 'orders.o_custkey', 'warn',
         (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
  UNION ALL
  SELECT 'relationships', 'lineitem.l_orderkey', 'warn',
         (SELECT count(*) FROM lineitem l WHERE l_orderkey IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = l.l_orderkey))
  UNION ALL
  SELECT 'relationships', 'orders.o_custkey', 'warn',
         (SELECT count(*) FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
  UNION ALL
  SELECT 'accepted_values', 'events.event_type', 'error',
         (SELECT count(DISTINCT event_type) FROM events
          WHERE event_type NOT IN ('click', 'view', 'purchase'))
)
SELECT check_name, column_name, severity, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM r
""",
)
def quality_report_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    ev = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer")
    return quality_report(
        [
            Check("unique", "lineitem.l_orderkey", check_unique(li, "l_orderkey"), "warn"),
            Check("not_null", "orders.o_custkey", check_not_null(orders, "o_custkey"), "warn"),
            Check(
                "relationships",
                "lineitem.l_orderkey",
                check_relationships(li, "l_orderkey", _valid_orders(spark, sf_dir), "o_orderkey"),
                "warn",
                count_rows=True,
            ),
            Check(
                "relationships",
                "orders.o_custkey",
                check_relationships(orders, "o_custkey", customer, "c_custkey"),
                "warn",
                count_rows=True,
            ),
            Check(
                "accepted_values",
                "events.event_type",
                check_accepted_values(ev, "event_type", ["click", "view", "purchase"]),
            ),
        ]
    )


# ---------------------------------------------------------------------------
# S3: sectioned text; S9 / S10: listing pages
# ---------------------------------------------------------------------------


@query(
    "section_lines",
    r"""
WITH t AS (
  SELECT doc_id,
         string_split(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n$', ''), chr(10)) AS parts
  FROM documents WHERE text IS NOT NULL
)
SELECT doc_id, line_no, line FROM (
  SELECT doc_id,
         unnest(CAST(range(0, len(parts) - 1) AS INTEGER[])) AS line_no,
         unnest(parts[1:len(parts) - 1]) AS line
  FROM t
)
""",
)
def section_lines_q(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents"), ["doc_id"])
    return section_lines(docs, "text", marker=None, keep=["doc_id"])


@query(
    "html_links",
    r"""
SELECT page_id, href FROM (
  SELECT page_id,
         replace(regexp_replace(unnest(regexp_extract_all(html,
                   '(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)), '^["'']|["'']$', '', 'g'),
                 '&amp;', '&') AS href
  FROM pages
)
""",
)
def html_links(spark, sf_dir):
    return extract_links(table(spark, sf_dir, "pages"), "html", carry=["page_id"])


_CATEGORY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([a-z]{2})/"


@query(
    "new_files",
    r"""
WITH links AS (
  SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([a-z]{2})/', 1) AS category,
         replace(regexp_replace(unnest(regexp_extract_all(html,
                   '(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)), '^["'']|["'']$', '', 'g'),
                 '&amp;', '&') AS href
  FROM pages
)
SELECT DISTINCT category, href FROM links c
WHERE category <> 'en'
  AND NOT EXISTS (SELECT 1 FROM links s WHERE s.category = 'en' AND s.href = c.href)
""",
)
def new_files_q(spark, sf_dir):
    """Hrefs listed under the other language folders that the 'en' folder
    has not fetched yet (the file name is the href, as in the download)."""
    pages = table(spark, sf_dir, "pages").withColumn("category", F.regexp_extract("url", _CATEGORY, 1))
    links = extract_links(pages, "html", carry=["category"])
    candidates = links.filter(F.col("category") != "en")
    stored = links.filter(F.col("category") == "en")
    return new_files(candidates, stored, "href")


# ---------------------------------------------------------------------------
# Partitioned table round trip
# ---------------------------------------------------------------------------


def _write_orders_by_month(spark, sf_dir, stale_month: bool = False) -> str:
    orders = table(spark, sf_dir, "orders").withColumn("month", year_month(F.col("o_orderdate")))
    path = shared_dir(spark, "orders_by_month", uuid.uuid4().hex)
    if stale_month:
        old = orders.limit(100).withColumn("month", F.lit("1900-01"))
        write_partitioned(orders.union(old), path, ["month"], cluster_by=["o_orderdate", "o_orderkey"])
    write_partitioned(orders, path, ["month"], cluster_by=["o_orderdate", "o_orderkey"], full_refresh=True)
    return path


@query(
    "partition_roundtrip",
    "SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders",
)
def partition_roundtrip(spark, sf_dir):
    # Written twice: the first load has a month that the second, a full refresh, must remove.
    return read_parquet(spark, _write_orders_by_month(spark, sf_dir, stale_month=True), {"month": "string"})


@query(
    "partition_slice",
    """
SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-07-01 00:00:00'
""",
)
def partition_slice(spark, sf_dir):
    df = read_parquet(spark, _write_orders_by_month(spark, sf_dir), {"month": "string"})
    return time_slice(df, "o_orderdate", "1996-01-01", "1996-07-01", partition_col="month")


@query(
    "published_table",
    "SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders",
)
def published_table(spark, sf_dir):
    """The orders dropped and loaded as a catalog table by month, and read by name."""
    orders = table(spark, sf_dir, "orders").withColumn("month", year_month(F.col("o_orderdate")))
    name = publish_table(orders, f"orders_{uuid.uuid4().hex}", ["month"], cluster_by=["o_orderdate", "o_orderkey"])
    return read_table(spark, name)


@query("unpartitioned_roundtrip", "SELECT * FROM orders")
def unpartitioned_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "orders_whole", uuid.uuid4().hex)
    write_partitioned(table(spark, sf_dir, "orders"), path, [], cluster_by=["o_orderdate", "o_orderkey"])
    return read_parquet(spark, path)


@query("written_rows", "SELECT 'orders' AS dataset, count(*) AS n_rows FROM orders")
def written_rows(spark, sf_dir):
    """The row count that is observed while a table is written."""
    seen = Observation("orders")
    path = shared_dir(spark, "orders_counted", uuid.uuid4().hex)
    write_partitioned(
        table(spark, sf_dir, "orders"), path, [], cluster_by=["o_orderdate", "o_orderkey"], observation=seen
    )
    return spark.createDataFrame([("orders", seen.get["rows"])], "dataset string, n_rows long")


@query(
    "ordered_rows",
    """
SELECT o_custkey, year, max_price, row_number() OVER (ORDER BY max_price DESC NULLS LAST, o_custkey, year) AS position
FROM (SELECT o_custkey, year(o_orderdate) AS year, max(o_totalprice) AS max_price FROM orders GROUP BY 1, 2)
""",
)
def ordered_rows(spark, sf_dir):
    """The largest order per customer and year, largest first, written as files in that order."""
    orders = table(spark, sf_dir, "orders")
    best = group_max(orders, ["o_custkey", F.year("o_orderdate").alias("year")], "o_totalprice", "max_price")
    path = shared_dir(spark, "ordered", uuid.uuid4().hex)
    write_ordered(best, path, [("max_price", True), ("o_custkey", False), ("year", False)])
    return read_parquet(spark, path)


@query(
    "station_slice",
    """
WITH s AS (SELECT user_id FROM events GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day
FROM events WHERE user_id = (SELECT user_id FROM s)
""",
)
def station_slice(spark, sf_dir):
    """All events of the busiest user from a table by day and clustered by time,
    whose files tell by Bloom filters which users they hold."""
    ev = table(spark, sf_dir, "events").drop("props").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    path = shared_dir(spark, "events_by_day", uuid.uuid4().hex)
    write_partitioned(ev, path, ["day"], cluster_by=["ts", "event_id"], bloom={"user_id": 10_000})
    busiest = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    user = top_k(busiest, 1, [F.col("n").desc(), F.col("user_id")]).first()  # one row
    rows = read_parquet(spark, path, {"day": "string"})
    return rows.filter(F.col("user_id") == F.lit(user.user_id if user else None))


@query(
    "file_ledger",
    r"""
WITH links AS (
  SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([a-z]{2})/', 1) AS category,
         replace(regexp_replace(unnest(regexp_extract_all(html,
                   '(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)), '^["'']|["'']$', '', 'g'),
                 '&amp;', '&') AS href
  FROM pages
)
SELECT href, CAST(min(CASE WHEN category = 'en' THEN 0 ELSE 1 END) AS BIGINT) AS batch,
       CAST(0 AS BIGINT) AS n_pending
FROM links GROUP BY href
""",
)
def file_ledger(spark, sf_dir):
    """Files stored in two batches, the first of which is recorded twice; nothing is then pending."""
    pages = table(spark, sf_dir, "pages").withColumn("category", F.regexp_extract("url", _CATEGORY, 1))
    links = extract_links(pages, "html", carry=["category"])
    ledger = Ledger(spark, shared_dir(spark, "ledger", uuid.uuid4().hex))
    english = links.filter(F.col("category") == "en").select("href")
    ledger.record(english, 0)
    ledger.record(english, 0)
    ledger.record(ledger.pending(links.select("href")), 1)
    pending = ledger.pending(links.select("href")).agg(F.count(F.lit(1)).alias("n_pending"))
    return ledger.entries().join(F.broadcast(pending))


# ---------------------------------------------------------------------------
# Delimited text bound by header
# ---------------------------------------------------------------------------

# Header cells as the files carry them (blank-padded), and their types.
EVENT_TEXT_COLUMNS = {
    "EVENT_ID": "long",
    "  TS": "timestamp_ntz",
    "USER_ID": "long",
    "  EVENT_TYPE": "string",
    " VALUE": "double",
}


def _write_event_text(spark, sf_dir) -> str:
    """The events as ';' text with header, the two categories written with
    different column orders, NULL written as the -999 sentinel."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("EVENT_ID"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("  TS"),
        F.col("user_id").alias("USER_ID"),
        F.col("event_type").alias("  EVENT_TYPE"),
        F.col("value").alias(" VALUE"),
    )
    path = shared_dir(spark, "event_text", uuid.uuid4().hex)
    cut = F.col("  TS") < F.lit("2024-01-15")
    layouts = {
        "historical": (cut, list(EVENT_TEXT_COLUMNS)),
        "recent": (~cut, list(reversed(EVENT_TEXT_COLUMNS))),
    }
    for category, (cond, order) in layouts.items():
        (
            ev.filter(cond)
            .select(*[F.col(f"`{c}`") for c in order])
            .write.mode("overwrite")
            .option("header", "true")
            .option("sep", ";")
            .option("nullValue", "-999")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(f"{path}/{category}")
        )
    return path


@query(
    "delimited_roundtrip",
    """
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 'historical' ELSE 'recent' END AS category
FROM events
""",
)
def delimited_roundtrip(spark, sf_dir):
    path = _write_event_text(spark, sf_dir)
    parts = {
        c: read_delimited(spark, f"{path}/{c}", EVENT_TEXT_COLUMNS, "EVENT_ID", glob="*.csv").drop("file")
        for c in ("historical", "recent")
    }
    return union_categories(parts)


# Lines with planted faults, by the event's value: text for a number, a cell too
# few, a blank id, a cell too many; then a missing value, which is none.
_FAULTY_LINE_SQL = """
       CASE WHEN value < 1 THEN event_id || ';' || user_id || ';' || event_type || ';n/a'
            WHEN value < 2 THEN event_id || ';' || user_id || ';' || event_type
            WHEN value < 3 THEN event_id || ';   ;' || event_type || ';' || CAST(value AS VARCHAR)
            WHEN value < 4 THEN event_id || ';' || user_id || ';' || event_type || ';' || CAST(value AS VARCHAR) || ';eor'
            WHEN value < 5 THEN event_id || ';' || user_id || ';' || event_type || ';-999'
            ELSE event_id || ';' || user_id || ';' || event_type || ';' || CAST(value AS VARCHAR) END"""
_FAULTY_COLUMNS = {"EVENT_ID": "long", "USER_ID": "long", "  EVENT_TYPE": "string", " VALUE": "double"}


@query(
    "rejected_lines",
    f"""
WITH l AS (
  SELECT *, {_FAULTY_LINE_SQL} AS line,
         CASE WHEN value < 1 THEN 'bad value in value' WHEN value < 2 THEN 'wrong number of cells'
              WHEN value < 3 THEN 'no value in user_id' WHEN value < 4 THEN 'wrong number of cells' END AS reason
  FROM events
)
SELECT CASE WHEN reason IS NULL THEN event_id END AS event_id, CASE WHEN reason IS NULL THEN user_id END AS user_id,
       CASE WHEN reason IS NULL THEN event_type END AS event_type,
       CASE WHEN reason IS NULL AND value >= 5 THEN value END AS value,
       CASE WHEN reason IS NOT NULL THEN line END AS line, reason,
       count(*) FILTER (reason IS NULL) OVER () AS n_rows, count(*) FILTER (reason IS NOT NULL) OVER () AS n_rejects
FROM l
""",
)
def rejected_lines(spark, sf_dir):
    """The events as delimited text with planted faults, read with a quarantine:
    good rows, rejects with line and reason, and the counts seen while writing."""
    line = F.expr(_FAULTY_LINE_SQL.replace("VARCHAR", "STRING"))
    path = shared_dir(spark, "faulty_text", uuid.uuid4().hex)
    header = ";".join(_FAULTY_COLUMNS)
    table(spark, sf_dir, "events").select(line.alias(header)).write.option("header", "true").option(
        "sep", "\u0001"
    ).option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    found = read_delimited_checked(
        spark, path, _FAULTY_COLUMNS, "EVENT_ID", glob="*.csv", required=["user_id"]
    )
    good = found.rows.drop("file").withColumns({"line": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")})
    bad = found.rejects.drop("file")
    counts = {"n_rows": F.lit(found.counts["rows"]).cast("long"), "n_rejects": F.lit(found.counts["rejects"]).cast("long")}
    return good.unionByName(bad, allowMissingColumns=True).withColumns(counts)


# ---------------------------------------------------------------------------
# Sectioned files
# ---------------------------------------------------------------------------

def _sectioned_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sectioned file per task: preamble, blank line, header, the rows, footer; CRLF line ends."""
    header = OPERATOR_MARKER.strip("\n ")
    yield pd.DataFrame({"value": ["Stationsname / Betreibername\r", "\r", header + "\r"]})
    yield from batches
    yield pd.DataFrame({"value": ["generiert: footer\r"]})


@query(
    "sectioned_roundtrip",
    """
SELECT CAST(doc_id AS VARCHAR) AS stations_id, source AS betreibername, lang AS betrieb_von_datum,
       '' AS betrieb_bis_datum
FROM documents
""",
)
def sectioned_roundtrip(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), ["doc_id"])
    path = shared_dir(spark, "sectioned", uuid.uuid4().hex)
    # Ids right-aligned, as published.
    lines = docs.select(F.format_string("%12d;%s;%s;\r", "doc_id", "source", "lang").alias("value"))
    lines.mapInPandas(_sectioned_lines, "value string").write.mode("overwrite").text(path)
    rows, _ = read_sectioned(
        spark,
        path,
        OPERATOR_MARKER,
        ["stations_id", "betreibername", "betrieb_von_datum", "betrieb_bis_datum"],
        glob="*.txt",
    )
    return rows.drop("file").withColumn("stations_id", F.replace("stations_id", F.lit(" "), F.lit("")))


# ---------------------------------------------------------------------------
# archives
# ---------------------------------------------------------------------------

# Member names given to document bodies by language, so that all routes
# occur: data members, metadata members, an .html member, an unrelated one.
_MEMBER_PREFIX = {
    "en": ("produkt_klima_tag_", ".txt"),
    "de": ("Metadaten_Geographie_", ".txt"),
    "fr": ("Metadaten_", ".html"),
    "es": ("beschreibung_", ".txt"),
}
_ARCHIVE_BYTES = 64 << 20


def _zip_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One archive per source and up to 64 MiB of bodies, per task."""
    for batch in batches:
        for source, group in batch.groupby("source", sort=False):
            buf, zf, size, part = io.BytesIO(), None, 0, 0
            for doc_id, lang, text in zip(group["doc_id"], group["lang"], group["text"]):
                if zf is None:
                    buf, size = io.BytesIO(), 0
                    zf = zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED)
                prefix, suffix = _MEMBER_PREFIX.get(lang, ("other_", ".txt"))
                body = (text or "").encode("utf-8")
                zf.writestr(f"{source}/{prefix}{doc_id}{suffix}", body)
                size += len(body)
                if size >= _ARCHIVE_BYTES:
                    zf.close()
                    yield pd.DataFrame({"archive": [f"{source}-{part}.zip"], "content": [buf.getvalue()]})
                    zf, part = None, part + 1
            if zf is not None:
                zf.close()
                yield pd.DataFrame({"archive": [f"{source}-{part}.zip"], "content": [buf.getvalue()]})


@query(
    "archive_members",
    """
SELECT member, route, n_bytes, body_sha256 FROM (
  SELECT source || '/' || CASE lang WHEN 'en' THEN 'produkt_klima_tag_' WHEN 'de' THEN 'Metadaten_Geographie_'
                            WHEN 'fr' THEN 'Metadaten_' WHEN 'es' THEN 'beschreibung_' ELSE 'other_' END
           || CAST(doc_id AS VARCHAR) || CASE lang WHEN 'fr' THEN '.html' ELSE '.txt' END AS member,
         CASE lang WHEN 'en' THEN 'tables' WHEN 'de' THEN 'metadata' END AS route,
         CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes, sha256(coalesce(text, '')) AS body_sha256
  FROM documents
) WHERE route IS NOT NULL
""",
)
def archive_members(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), ["doc_id"])
    archives = docs.mapInPandas(_zip_documents, "archive string, content binary")
    members = route_members(explode_archives(archives))
    return members.select("member", "route", F.length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("body_sha256"))


# ---------------------------------------------------------------------------
# The whole pipeline: raw text -> clean files -> staging -> dims -> fact
# ---------------------------------------------------------------------------

_STATION_SQL = (
    "CASE WHEN length(CAST({c} AS VARCHAR)) < 5 THEN lpad(CAST({c} AS VARCHAR), 5, '0') "
    "ELSE CAST({c} AS VARCHAR) END"
)
_UTC_SQL = "((date_trunc('day', {c}) AT TIME ZONE 'Europe/Brussels') AT TIME ZONE 'UTC')"
_UTC_END_SQL = "((date_trunc('day', {c}) - INTERVAL 1 DAY) AT TIME ZONE 'Europe/Brussels') AT TIME ZONE 'UTC'"

# Measures of the raw files, by header; NULL where a file has -999. The rich files fill them all.
_PLAIN_CELLS = {
    "qn_3": "10", "fx": "value", "fm": "CAST(NULL AS DOUBLE)",
    "qn_4": "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 3 WHEN 'purchase' THEN 5 WHEN 'error' THEN 7 WHEN 'signup' THEN 9 END",
    "rsk": "value", "rskf": "0", "sdk": "value", "shk_tag": "0", "nm": "CAST(NULL AS VARCHAR)",
    "vpm": "CAST(NULL AS DOUBLE)", "pm": "CAST(NULL AS DOUBLE)", "tmk": "value", "upm": "CAST(NULL AS DOUBLE)",
    "txk": "CAST(NULL AS DOUBLE)", "tnk": "CAST(NULL AS DOUBLE)", "tgk": "CAST(NULL AS DOUBLE)",
}
_RICH_CELLS = _PLAIN_CELLS | {
    "qn_3": "CASE WHEN value < 1 THEN 4 ELSE 10 END", "fm": "value + 0.25",
    "qn_4": _PLAIN_CELLS["qn_4"].replace("'click' THEN 1", "'click' THEN 6"),
    "rskf": "CASE WHEN value < 2 THEN 5 ELSE 6 END", "shk_tag": "CASE WHEN value < 50 THEN 300 ELSE 7 END",
    "nm": "CASE WHEN event_type = 'view' THEN '5.33' END", "vpm": "value + 1", "pm": "value + 1000", "upm": "80.5",
    "txk": "value + 5", "tnk": "value - 5", "tgk": "value - 6.5",
}


def _weather_ctes(variant: Variant) -> str:
    cells = _RICH_CELLS if variant.faults else _PLAIN_CELLS
    station, operator = ("Größe Ävår ", "Wetterdienst ÄÖÜß ") if variant.faults else ("Station ", "Operator ")
    located = f"AND value >= {RICH_GEO_VALUE}" if variant.faults else ""
    op_end = (_UTC_SQL if variant.faults else _UTC_END_SQL).format(c="next_ts")
    return f"""
WITH ev AS (
  SELECT * REPLACE (ts + INTERVAL {variant.shift_days} DAY AS ts) FROM events
), raw AS (
  SELECT *, 'historical' AS category FROM ev WHERE ts < TIMESTAMP '{variant.historical_until} 00:00:00'
  UNION ALL
  SELECT *, 'recent' AS category FROM ev WHERE ts >= TIMESTAMP '{variant.recent_from} 00:00:00'
), clean AS (
  SELECT {_STATION_SQL.format(c="user_id")} AS stations_id,
         {_UTC_SQL.format(c="ts")} AS mess_datum,
         {", ".join(f"{sql} AS {name}" for name, sql in cells.items())}, category, strftime(ts, '%Y') AS year
  FROM raw
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY stations_id, mess_datum
    ORDER BY (category = 'historical') DESC NULLS LAST, qn_4 DESC NULLS LAST, qn_3 DESC NULLS LAST,
             fx ASC NULLS FIRST, fm ASC NULLS FIRST, rsk ASC NULLS FIRST, rskf ASC NULLS FIRST,
             sdk ASC NULLS FIRST, shk_tag ASC NULLS FIRST, nm ASC NULLS FIRST, vpm ASC NULLS FIRST,
             pm ASC NULLS FIRST, tmk ASC NULLS FIRST, upm ASC NULLS FIRST, txk ASC NULLS FIRST,
             tnk ASC NULLS FIRST, tgk ASC NULLS FIRST, category ASC NULLS FIRST, year ASC NULLS FIRST) AS _rn
  FROM clean WHERE stations_id IS NOT NULL AND mess_datum IS NOT NULL
), stg AS (
  SELECT md5(concat_ws('-', stations_id, strftime(mess_datum, '%Y-%m-%d %H:%M:%S') || '+00')) AS measurement_id,
         stations_id AS station_id, mess_datum AS dt_measurement_utc,
         CAST(round(qn_3) AS INTEGER) AS quality_niveau_3, CAST(round(qn_4) AS INTEGER) AS quality_niveau_4,
         round(fx, 2) AS max_wind_gust_mps_qn3, round(fm, 2) AS mean_wind_velocity_mps_qn3,
         round(rsk, 2) AS precipitation_heigt_mm_qn4, CAST(round(rskf) AS INTEGER) AS precipitation_type_qn4,
         CAST(round(sdk) AS INTEGER) AS sunshine_duration_h_qn4, CAST(round(shk_tag) AS INTEGER) AS snow_depth_cm_qn4,
         nm AS mean_cloud_coverage_qn4, round(vpm, 2) AS mean_vapour_pressure_hpa_qn4,
         round(pm, 2) AS mean_pressure_hpa_qn4, round(tmk, 2) AS mean_temperature_2m_c_qn4,
         round(upm, 2) AS mean_rel_humidity_qn4, round(txk, 2) AS max_temperature_2m_c_qn4,
         round(tnk, 2) AS min_temperature_2m_c_qn4, round(tgk, 2) AS mean_temperature_5cm_c_qn4
  FROM ranked WHERE _rn = 1
), geo_src AS (
  SELECT user_id, event_id, value, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
  FROM ev WHERE event_type = 'signup' {located}
), geo AS (
  SELECT {_STATION_SQL.format(c="user_id")} AS station_id, value AS station_height_m,
         CAST(value AS VARCHAR) AS latitude, CAST(user_id + 0.5 AS VARCHAR) AS longitude,
         {_UTC_SQL.format(c="ts")} AS dt_geo_start,
         CASE WHEN next_ts IS NULL THEN NULL ELSE {_UTC_END_SQL.format(c="next_ts")} END AS dt_geo_end,
         '{station}' || CAST(event_id AS VARCHAR) AS station_name
  FROM geo_src
), op_src AS (
  SELECT user_id, event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
  FROM ev WHERE event_type = 'error'
), op AS (
  SELECT {_STATION_SQL.format(c="user_id")} AS station_id, '{operator}' || CAST(event_id AS VARCHAR) AS operator_name,
         {_UTC_SQL.format(c="ts")} AS dt_op_start,
         CASE WHEN next_ts IS NULL THEN NULL ELSE {op_end} END AS dt_op_end
  FROM op_src
)"""


_WEATHER_CTES = _weather_ctes(PLAIN)

_WEATHER_FACT_SELECT = """
SELECT s.measurement_id, s.station_id, s.dt_measurement_utc, g.station_name, o.operator_name,
       g.station_height_m, g.latitude || ',' || g.longitude AS lat_long,
       s.quality_niveau_3, s.quality_niveau_4, s.max_wind_gust_mps_qn3, s.mean_wind_velocity_mps_qn3,
       s.precipitation_heigt_mm_qn4, s.precipitation_type_qn4, s.sunshine_duration_h_qn4,
       s.snow_depth_cm_qn4, s.mean_cloud_coverage_qn4, s.mean_vapour_pressure_hpa_qn4,
       s.mean_pressure_hpa_qn4, s.mean_temperature_2m_c_qn4, s.mean_rel_humidity_qn4,
       s.max_temperature_2m_c_qn4, s.min_temperature_2m_c_qn4, s.mean_temperature_5cm_c_qn4,
       strftime(s.dt_measurement_utc, '%Y-%m') AS month
FROM stg s
LEFT JOIN geo g ON s.station_id = g.station_id AND s.dt_measurement_utc >= g.dt_geo_start
  AND (g.dt_geo_end IS NULL OR s.dt_measurement_utc <= g.dt_geo_end)
LEFT JOIN op o ON s.station_id = o.station_id AND s.dt_measurement_utc >= o.dt_op_start
  AND (o.dt_op_end IS NULL OR s.dt_measurement_utc <= o.dt_op_end)
"""

WEATHER_FACT_SQL = _WEATHER_CTES + _WEATHER_FACT_SELECT

_ACCEPTED = {
    "quality_niveau_3": ", ".join(map(str, QUALITY_LEVELS)),
    "quality_niveau_4": ", ".join(map(str, QUALITY_LEVELS)),
    "precipitation_type_qn4": ", ".join(map(str, PRECIPITATION_FORMS)),
}

def _weather_checks_sql(variant: Variant) -> str:
    return (
        _weather_ctes(variant)
        + ", fact AS ("
        + _WEATHER_FACT_SELECT
        + "), r AS (\n"
        + "  SELECT 'unique' AS check_name, 'measurement_id' AS column_name, 'warn' AS severity,\n"
        + "         (SELECT count(*) FROM (SELECT measurement_id FROM fact WHERE measurement_id IS NOT NULL\n"
        + "                                GROUP BY 1 HAVING count(*) > 1)) AS failures\n"
        + "".join(
            f"  UNION ALL SELECT 'relationships', 'station_id->{name}', 'warn',\n"
            f"         (SELECT count(*) FROM fact f WHERE f.station_id IS NOT NULL AND NOT EXISTS (\n"
            f"            SELECT 1 FROM {cte} d WHERE d.station_id = f.station_id))\n"
            for name, cte in (("dim_geo", "geo"), ("dim_operator", "op"))
        )
        + "".join(
            f"  UNION ALL SELECT 'not_null', '{c}', 'warn', (SELECT count(*) FROM fact WHERE {c} IS NULL)\n"
            for c in ("measurement_id", "station_id", "dt_measurement_utc")
        )
        + "".join(
            f"  UNION ALL SELECT 'accepted_values', '{c}', 'error',\n"
            f"         (SELECT count(DISTINCT {c}) FROM fact WHERE {c} IS NOT NULL AND {c} NOT IN ({values}))\n"
            for c, values in _ACCEPTED.items()
        )
        + ")\n"
        + "SELECT check_name, column_name, severity, CAST(failures AS BIGINT) AS failures,\n"
        + "       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status\n"
        + "FROM r"
    )


WEATHER_CHECKS_SQL = _weather_checks_sql(PLAIN)


def _run_weather(spark, sf_dir, variant: Variant = PLAIN, **join_options):
    root = shared_dir(spark, "weather", uuid.uuid4().hex)
    globs = write_raw_from_events(table(spark, sf_dir, "events"), f"{root}/raw", variant)
    paths = weather.run_raw(spark, f"{root}/raw", f"{root}/clean", globs=globs)
    return weather.run_marts(spark, paths, f"{root}/marts", **join_options)


@query("weather_fact", WEATHER_FACT_SQL)
def weather_fact(spark, sf_dir):
    """The published pipeline end to end on raw files Spark derives from
    ``events`` (``plans.derived``): header-bound text, latin-1 location
    history, sectioned operator history -> clean files -> staging view
    (dedup, keys, casts) -> dims -> effective-dated fact by month."""
    fact_path, _ = _run_weather(spark, sf_dir)
    return read_parquet(spark, fact_path, {"month": "string"})


@query("weather_fact_bucketed", WEATHER_FACT_SQL)
def weather_fact_bucketed(spark, sf_dir):
    """``weather_fact`` with both histories joined as if too large to broadcast."""
    fact_path, _ = _run_weather(spark, sf_dir, max_broadcast_rows=-1)
    return read_parquet(spark, fact_path, {"month": "string"})


def _publish(spark, sf_dir, variant: Variant = PLAIN, **options) -> dict[str, str]:
    root = shared_dir(spark, "weather", uuid.uuid4().hex)
    globs = write_raw_from_events(table(spark, sf_dir, "events"), f"{root}/raw", variant)
    paths = weather.run_raw(spark, f"{root}/raw", f"{root}/clean", globs=globs)
    return weather.publish_marts(spark, paths, f"marts_{uuid.uuid4().hex}_", **options)


@query("published_marts", WEATHER_FACT_SQL)
def published_marts(spark, sf_dir):
    """The fact read by name after the raw table by month, both dims and the
    fact were loaded as versions behind their names."""
    return read_table(spark, _publish(spark, sf_dir)["fact_measurements"])


@query(
    "published_dims",
    _WEATHER_CTES
    + """
SELECT 'dim_geo' AS dim, station_id, station_name AS name, dt_geo_start AS valid_from, dt_geo_end AS valid_to,
       station_height_m, latitude, longitude FROM geo
UNION ALL
SELECT 'dim_operator', station_id, operator_name, dt_op_start, dt_op_end, NULL, NULL, NULL FROM op
""",
)
def published_dims(spark, sf_dir):
    """Both dims read by name from their published versions."""
    names = _publish(spark, sf_dir)
    geo, op = read_table(spark, names["dim_geo"]), read_table(spark, names["dim_operator"])
    both = {
        "dim_geo": (geo, "station_name", "dt_geo_start", "dt_geo_end", ["station_height_m", "latitude", "longitude"]),
        "dim_operator": (op, "operator_name", "dt_op_start", "dt_op_end", []),
    }
    parts = [
        df.select(
            F.lit(dim).alias("dim"), "station_id", F.col(name).alias("name"), F.col(lo).alias("valid_from"), F.col(hi).alias("valid_to"), *rest
        )
        for dim, (df, name, lo, hi, rest) in both.items()
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


FACT_LAYOUT_SQL = (
    _WEATHER_CTES
    + ", fact AS ("
    + _WEATHER_FACT_SELECT
    + ")\nSELECT month, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_overlaps FROM fact GROUP BY month"
)


@query("fact_layout", FACT_LAYOUT_SQL)
def fact_layout(spark, sf_dir):
    """Per month the rows of the fact and its files whose time range reaches
    into the next file's, where one history outgrows the broadcast by its size
    alone: the sweep ends the order, and the write restores it."""
    fact_path, _ = _run_weather(spark, sf_dir, max_broadcast_bytes=4096)
    rows = read_parquet(spark, fact_path, {"month": "string"})
    at = F.struct("dt_measurement_utc", "station_id")
    files = rows.groupBy("month", F.col("_metadata.file_path").alias("file")).agg(
        F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n")
    )
    # One row per file: a month has as many as its tasks.
    after = F.lead("lo").over(Window.partitionBy("month").orderBy("lo", "hi"))
    files = files.withColumn("overlaps", F.coalesce((F.col("hi") > after).cast("long"), F.lit(0)))
    return files.groupBy("month").agg(F.sum("n").alias("n_rows"), F.sum("overlaps").alias("n_overlaps"))


@query("weather_fact_rich", _weather_ctes(RICH) + _WEATHER_FACT_SELECT)
def weather_fact_rich(spark, sf_dir):
    """``weather_fact`` on files with every measure filled, names beyond ASCII, a
    change to summer time, stations without a location and operators that overlap."""
    fact_path, _ = _run_weather(spark, sf_dir, RICH)
    return read_parquet(spark, fact_path, {"month": "string"})


@query("weather_checks_failing", _weather_checks_sql(RICH))
def weather_checks_failing(spark, sf_dir):
    """``weather_checks`` on the same files: tests of every kind fail, as warnings and as errors."""
    _, report = _run_weather(spark, sf_dir, RICH)
    return report


_STAGING_CHECKS_SQL = (
    _weather_ctes(RICH)
    + "".join(
        f"{'SELECT' if k == 0 else 'UNION ALL SELECT'} '{name}' AS check_name, '{c}' AS column_name, '{sev}' AS severity,\n"
        f"       (SELECT count(*) FROM stg WHERE {bad}) AS failures\n"
        for k, (name, c, sev, bad) in enumerate(
            [("not_null", c, "warn", f"{c} IS NULL") for c in ("measurement_id", "station_id", "dt_measurement_utc")]
            + [("accepted_values", c, "error", f"{c} NOT IN ({v})") for c, v in _ACCEPTED.items()]
        )
    )
)


@query(
    "published_report",
    f"""
SELECT *, 'fact_measurements' AS model FROM ({_weather_checks_sql(RICH)})
UNION ALL
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status,
       'stg_measurements' AS model FROM ({_STAGING_CHECKS_SQL})
""",
)
def published_report(spark, sf_dir):
    """The declared tests of staging, counted while its rows passed into the
    fact, and of the fact's new version, read by name."""
    names = _publish(spark, sf_dir, RICH, fail_on_error=False)
    return read_table(spark, names["quality_report"])


def _refreshed(spark, sf_dir) -> str:
    root = shared_dir(spark, "weather", uuid.uuid4().hex)
    globs = write_raw_from_events(table(spark, sf_dir, "events"), f"{root}/raw")

    def measured(category: str) -> DataFrame:
        rows = weather.fetch_measurements(spark, f"{root}/raw", [category], globs["main"])
        return materialize(weather.transform_measurements(rows), category)

    def located() -> DataFrame:
        geo = weather.fetch_geo(spark, f"{root}/raw", ["historical"], globs["metadata_geo"])
        return materialize(weather.dim_geo(weather.transform_history(geo, "stations_id", ["von_datum", "bis_datum"])), "geo")

    def operated() -> DataFrame:
        op, _ = weather.fetch_operator(spark, f"{root}/raw", glob=globs["metadata_operator"])
        op = weather.transform_history(op, "stations_id", ["betrieb_von_datum", "betrieb_bis_datum"])
        return materialize(weather.dim_operator(op), "operator")

    # A late batch may be delivered twice and every refresh reads the histories: all are parsed once.
    historical, recent, *dims = at_once(lambda: measured("historical"), lambda: measured("recent"), located, operated)
    files = {"historical": historical, "recent": recent}
    for batch, category in ((0, "historical"), (1, "recent"), (1, "recent")):
        weather.refresh_months(spark, files[category], f"{root}/monthly", *dims, batch=batch)
    return f"{root}/monthly"


@query("incremental_fact", WEATHER_FACT_SQL)
def incremental_fact(spark, sf_dir):
    """The fact built from the historical files, then refreshed with the recent
    ones as a late batch that is delivered twice: only the months they touch are
    read, deduplicated and replaced."""
    return read_parquet(spark, f"{_refreshed(spark, sf_dir)}/fact_measurements", {"month": "string"})


@query(
    "summary_answers",
    _WEATHER_CTES
    + ", fact AS ("
    + _WEATHER_FACT_SELECT
    + """)
SELECT CAST(year(dt_measurement_utc) AS INTEGER) AS year, count(*) AS n_rows, max(dt_measurement_utc) AS last_utc,
       (SELECT max(dt_measurement_utc) FROM fact) AS latest, (SELECT count(*) FROM fact) AS n_all
FROM fact GROUP BY 1
""",
)
def summary_answers(spark, sf_dir):
    """Years, row counts and the latest time of the refreshed fact, from its month
    summary alone: no row of the fact is read."""
    months = read_parquet(spark, f"{_refreshed(spark, sf_dir)}/month_summary", {"month": "string"})
    years = months.groupBy(F.substring("month", 1, 4).cast("int").alias("year")).agg(
        F.sum("n_rows").alias("n_rows"), F.max("last_utc").alias("last_utc")
    )
    whole = months.agg(F.max("last_utc").alias("latest"), F.sum("n_rows").alias("n_all"))  # one row
    return years.join(F.broadcast(whole))


@query(
    "local_day_slice",
    _weather_ctes(RICH)
    + ", fact AS ("
    + _WEATHER_FACT_SELECT
    + """)
SELECT *, CAST((dt_measurement_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Brussels' AS DATE) AS obs_date FROM fact
WHERE CAST((dt_measurement_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Brussels' AS DATE)
      BETWEEN DATE '2024-04-01' AND DATE '2024-04-10'
""",
)
def local_day_slice_q(spark, sf_dir):
    """The first ten local days of April, the first of which is in March by UTC
    (and after the change to summer time)."""
    fact_path, _ = _run_weather(spark, sf_dir, RICH)
    fact = read_parquet(spark, fact_path, {"month": "string"})
    rows = local_day_slice(fact, "dt_measurement_utc", "2024-04-01", "2024-04-10", partition_col="month")
    return rows.withColumn("obs_date", obs_date(F.col("dt_measurement_utc")))


@query("staging_test_run", _WEATHER_CTES + "\nSELECT * FROM stg ORDER BY measurement_id LIMIT 100")
def staging_test_run(spark, sf_dir):
    """The staging model under its run variable: ordered by key, then the first 100 rows."""
    root = shared_dir(spark, "weather", uuid.uuid4().hex)
    globs = write_raw_from_events(table(spark, sf_dir, "events"), f"{root}/raw")
    paths = weather.run_raw(spark, f"{root}/raw", f"{root}/clean", globs=globs)
    return weather.stg_measurements(weather.read_raw(spark, paths)[0], test_run=True)


@query("weather_checks", WEATHER_CHECKS_SQL)
def weather_checks(spark, sf_dir):
    """The declared tests of the published fact (unique and not-null keys,
    both relationships, accepted quality and precipitation codes) as one
    report with severity and status."""
    _, report = _run_weather(spark, sf_dir)
    return report
