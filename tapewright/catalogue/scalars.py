"""Scalar functions over whole columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapewright.catalogue import query
from tapewright.catalogue.texts import SPACE
from tapewright.functions import dates, numbers, strings
from tapewright.operators.clean import is_material
from tapewright.sources import payloads
from tapewright.sources.tables import parquet

RUN = dt.datetime(2024, 2, 1, 6, 0, 0)


@query("scalar_strings", f"""
SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS upper_name,
       CASE WHEN length(p_partkey) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0') ELSE CAST(p_partkey AS VARCHAR) END AS padded,
       replace(p_brand, '#', '') AS no_hash, CAST(lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS BIGINT)::VARCHAR AS unpadded,
       CASE WHEN p_size > 10 THEN 'https://www.sec.gov/Archives/edgar/data/' || p_partkey || '/' || replace(p_brand, '-', '') || '/' || p_type END AS url,
       substring(p_name, 1, 5) AS clipped, CASE WHEN length(p_name) >= 8 THEN substring(p_name, 1, 8) || '...' ELSE p_name END AS marked,
       contains(lower(p_name), 'ed') AS has_literal, lower(p_name) LIKE '%r_d%' AS has_wild,
       CAST(length(p_name) AS INTEGER) AS n_chars, COALESCE(CASE WHEN p_size > 25 THEN p_type END, '?') AS type_or_mark
FROM (SELECT * REPLACE (CAST(p_partkey AS VARCHAR) AS p_partkey) FROM part)""".replace(
    "SELECT p_partkey, upper", "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, upper"))
def scalar_strings(spark, sf):
    name, key = F.col("p_name"), F.col("p_partkey").cast("string")
    document = F.when(F.col("p_size") > 10, F.col("p_type"))
    padded = strings.zero_pad(key, 10)
    return parquet(spark, sf, "part").select(
        "p_partkey",
        F.upper(strings.strip(F.concat(F.lit("  "), name, F.lit(" ")))).alias("upper_name"),
        strings.zero_pad(key, 6).alias("padded"),
        F.replace("p_brand", F.lit("#"), F.lit("")).alias("no_hash"),
        strings.without_zeros(padded).alias("unpadded"),
        strings.archive_url(padded, F.col("p_brand"), document).alias("url"),
        strings.clip(name, 5).alias("clipped"),
        strings.clip_marked(name, 8).alias("marked"),
        strings.contains_literal(name, "ED").alias("has_literal"),
        strings.contains_wild(name, "R_D").alias("has_wild"),
        F.length(name).alias("n_chars"),
        strings.or_default(F.when(F.col("p_size") > 25, F.col("p_type")), "?").alias("type_or_mark"),
    )


@query("scalar_urls", """
SELECT page_id, regexp_replace(url, '/[^/]*$', '') AS base, starts_with(url, 'http') AS absolute,
       regexp_replace(url, '/[^/]*$', '') || '/next.htm' AS resolved FROM pages""")
def scalar_urls(spark, sf):
    url = F.col("url")
    return parquet(spark, sf, "pages").select(
        "page_id", strings.url_base(url).alias("base"), url.startswith("http").alias("absolute"),
        strings.resolve(F.lit("next.htm"), url).alias("resolved"),
    )


@query("scalar_words", f"""
SELECT doc_id, CAST(len(list_distinct(list_filter(string_split(trim(regexp_replace(lower(text),
  '{SPACE}', ' ', 'g')), ' '), lambda w: w <> ''))) AS INTEGER) AS distinct_words FROM documents""")
def scalar_words(spark, sf):
    words = strings.word_set(F.col("text"))
    return parquet(spark, sf, "documents").select("doc_id", F.size(words).alias("distinct_words"))


@query("scalar_dates", """
SELECT o_orderkey, CAST(abs(CAST(o_orderdate AS DATE) - DATE '1998-01-01') AS INTEGER) AS gap,
       CAST(o_orderdate AS DATE) + 7 AS next_week, CAST(o_orderdate AS DATE) - 7 AS last_week,
       strftime(o_orderdate, '%Y-%m') AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       strftime(o_orderdate, '%G-W%V') AS iso_week, strftime(o_orderdate, '%Y-W%V') AS mixed_week,
       strftime(o_orderdate, '%b %d %H:%M UTC') AS stamp,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS parsed,
       last_day(CAST(o_orderdate AS DATE)) AS month_end, o_orderdate >= TIMESTAMP '2001-06-30' - INTERVAL 90 DAY AS recent
FROM orders""")
def scalar_dates(spark, sf):
    day = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("31/12/9")
    return parquet(spark, sf, "orders").select(
        "o_orderkey",
        dates.day_gap(day, F.lit(dt.date(1998, 1, 1))).alias("gap"),
        F.date_add(day, 7).alias("next_week"),
        F.date_sub(day, 7).alias("last_week"),
        dates.month_label(day).alias("month"),
        F.year(day).alias("year"),
        dates.week_label(day).alias("iso_week"),
        dates.week_label(day, compat=True).alias("mixed_week"),
        dates.stamp_label(F.col("o_orderdate")).alias("stamp"),
        dates.to_day(text).alias("parsed"),
        F.last_day(day).alias("month_end"),
        dates.since(day, dt.date(2001, 6, 30), 90).alias("recent"),
    )


@query("scalar_timestamps", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed,
       CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS day FROM events""")
def scalar_timestamps(spark, sf):
    """ISO texts to timestamps; a malformed one is NULL."""
    text = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")
    parsed = dates.to_ts(text)
    return parquet(spark, sf, "events").select(
        "event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"), dates.to_day(parsed).alias("day")
    )


@query("scalar_math", """
SELECT event_id, abs(value - 50) AS gap, CASE WHEN value <> 0 THEN 100 / value END AS ratio,
       CASE WHEN user_id % 3 <> 0 THEN (value - user_id % 3) / abs(user_id % 3) * 100 END AS pct,
       least(CAST(100 AS DOUBLE), value) AS capped, value / CAST(1048576 AS DOUBLE) AS mega,
       CASE WHEN value > 50 THEN 'up' WHEN value < 50 THEN 'down' ELSE 'up' END AS direction
FROM events""")
def scalar_math(spark, sf):
    value, base = F.col("value"), (F.col("user_id") % 3).cast("double")
    return parquet(spark, sf, "events").select(
        "event_id",
        F.abs(value - 50).alias("gap"),
        F.try_divide(F.lit(100.0), value).alias("ratio"),
        numbers.pct_of_base(value - base, base).alias("pct"),
        F.least(F.lit(100.0), value).alias("capped"),
        numbers.mega(value).alias("mega"),
        numbers.direction(value - 50, "up").alias("direction"),
    )


@query("scalar_conditions", """
SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(f = 'A', FALSE) AS material, COALESCE(f, 'general') AS category,
       COUNT(*) AS n
FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS f FROM lineitem) GROUP BY 1, 2, 3, 4, 5""")
def scalar_conditions(spark, sf):
    form = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    rows = parquet(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        is_material(form, "A").alias("material"), strings.or_default(form, "general").alias("category"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query("scalar_nested", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, NULL::INTEGER AS missing,
       CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS code,
       CASE WHEN event_type IN ('click', 'view') THEN event_type END AS shared,
       CASE WHEN user_id % 4 < 3 THEN CAST(user_id % 4 AS INTEGER) END AS picked,
       '2024-02-01 06:00:00' AS loaded
FROM events""")
def scalar_nested(spark, sf):
    """JSON fields, map and array look-ups with a default, set intersection, load stamp."""
    props = F.from_json("props", "struct<k: int, other: int>")
    codes = F.create_map(F.lit("click"), F.lit(1), F.lit("view"), F.lit(2))
    shared = F.array_intersect(F.array("event_type"), F.array(F.lit("click"), F.lit("view")))
    return parquet(spark, sf, "events").select(
        "event_id",
        props["k"].alias("k"),
        props["other"].alias("missing"),
        F.coalesce(F.try_element_at(codes, F.col("event_type")), F.lit(0)).alias("code"),
        F.get(shared, F.lit(0)).alias("shared"),
        F.get(F.array(F.lit(0), F.lit(1), F.lit(2)), (F.col("user_id") % 4).cast("int")).alias("picked"),
        F.date_format(payloads.load_stamp(RUN), "yyyy-MM-dd HH:mm:ss").alias("loaded"),
    )
