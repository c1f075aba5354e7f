"""Queries on time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators import series as G
from ...sources import payloads
from . import query, table
from .views import ANCHORS, ISSUES, anchors, issues

EVENTS_OBS = "obs AS (SELECT event_type AS series_id, ts, value, event_id AS tie FROM events)"
LAG = "lagged AS (SELECT *, lag(value) OVER w AS prev_value, lag(ts) OVER w AS prev_ts FROM obs WINDOW w AS (PARTITION BY series_id ORDER BY ts, tie))"


def _events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series_id"), F.col("ts").cast("timestamp").alias("ts"), "value", F.col("event_id").alias("tie"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("tie"))


ORDERS_OBS = "obs AS (SELECT o_orderpriority AS series_id, o_orderdate AS ts, o_totalprice AS value, o_orderkey AS tie FROM orders)"
MONTHS = f"{ORDERS_OBS}, m AS (SELECT series_id, date_trunc('month', ts) AS month, arg_max(value, (ts, tie)) AS value FROM obs GROUP BY ALL)"


@query("level_change", f"""
WITH {EVENTS_OBS}, {LAG}
SELECT tie AS event_id, series_id, value, prev_value, CAST(round((value - prev_value) * 100) AS BIGINT) AS delta_bp,
  round(abs(value - prev_value), 4) AS delta_points FROM lagged WHERE abs(value - prev_value) >= 0.05 AND value <> prev_value""")
def level_change(spark: SparkSession, sf: str) -> DataFrame:
    return G.level_changes(_events(spark, sf), 0.05).select(
        F.col("tie").alias("event_id"), "series_id", "value", "prev_value", "delta_bp", "delta_points")


@query("new_period", f"""
WITH {ORDERS_OBS}, {LAG}
SELECT tie AS order_id, series_id, strftime(date_trunc('month', ts), '%Y-%m') AS period, value FROM lagged
WHERE date_trunc('month', ts) <> date_trunc('month', prev_ts) AND ts >= TIMESTAMP '1996-01-01'""")
def new_period(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.new_periods(_orders(spark, sf), F.lit("1996-01-01").cast("timestamp"), unit="day")
    return rows.select(F.col("tie").alias("order_id"), "series_id", F.date_format("period", "yyyy-MM").alias("period"), "value")


@query("history_events", f"""
WITH {EVENTS_OBS}, {LAG}
SELECT series_id || '_' || strftime(ts, '%Y-%m-%d') || '_' || tie AS key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, value, prev_value AS prev
FROM lagged WHERE value <> prev_value""")
def history_events(spark: SparkSession, sf: str) -> DataFrame:
    """Past level changes as events that keep their original date."""
    rows = G.level_changes(_events(spark, sf), 0.0)
    return rows.select(
        F.concat_ws("_", "series_id", F.date_format("ts", "yyyy-MM-dd"), F.col("tie").cast("string")).alias("key"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "value", F.col("prev_value").alias("prev"))


@query("series_state", f"""
WITH {EVENTS_OBS} SELECT series_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts, arg_max(value, (ts, tie)) AS value FROM obs GROUP BY series_id""")
def series_state(spark: SparkSession, sf: str) -> DataFrame:
    return G.latest_state(_events(spark, sf)).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("period_last", f"WITH {MONTHS} SELECT series_id, strftime(month, '%Y-%m') AS month, value FROM m")
def period_last(spark: SparkSession, sf: str) -> DataFrame:
    return G.month_end(_orders(spark, sf)).withColumn("month", F.date_format("month", "yyyy-MM"))


@query("year_over_year", f"""
WITH {MONTHS} SELECT a.series_id, strftime(a.month, '%Y-%m') AS month, a.value, round((a.value / b.value - 1) * 100, 2) AS yoy
FROM m a JOIN m b ON a.series_id = b.series_id AND a.month = b.month + INTERVAL 1 YEAR WHERE b.value <> 0""")
def year_over_year(spark: SparkSession, sf: str) -> DataFrame:
    return G.year_over_year(G.month_end(_orders(spark, sf))).withColumn("month", F.date_format("month", "yyyy-MM"))


@query("last_n", f"""
WITH {MONTHS} SELECT series_id, strftime(month, '%Y-%m') AS month, value, CAST(rn AS INTEGER) AS rn FROM
(SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS rn FROM m) WHERE rn <= 36""")
def last_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.last_points(G.month_end(_orders(spark, sf)), 36, "month")
    return rows.select("series_id", F.date_format("month", "yyyy-MM").alias("month"), "value", "rn")


@query("series_merge", """
WITH b AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS t, o_totalprice AS value, o_orderkey AS tie,
                  CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS batch FROM orders),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, t ORDER BY batch DESC, tie DESC) AS r FROM b) WHERE r = 1)
SELECT series_id, strftime(t, '%Y-%m-%d') AS t, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY t DESC) AS rn FROM c) WHERE rn <= 120""")
def series_merge(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    rows = o.select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("t"),
                    F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("tie"), "o_orderstatus")
    stored, batch = rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"), rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus")
    return G.merge_series(stored, batch).select("series_id", F.date_format("t", "yyyy-MM-dd").alias("t"), "value")


@query("quarterly_groups", f"""
WITH {ANCHORS},
u AS (SELECT issue_id, arg_max(unit, (period, seq)) AS unit FROM anchors WHERE metric <> '변동폭' GROUP BY 1),
c AS (SELECT issue_id, metric, period, arg_max_null(value, seq) AS value FROM anchors WHERE metric <> '변동폭' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY issue_id, metric ORDER BY period DESC) AS rn FROM c)
SELECT issue_id, metric, unit, string_agg(period || '=' || coalesce(CAST(CAST(value AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY period) AS series
FROM r JOIN u USING (issue_id) WHERE rn <= 4 GROUP BY ALL""")
def quarterly_groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.quarterly_groups(anchors(spark, sf))
    shown = F.transform("series", lambda p: F.concat(p["t"], F.lit("="), F.coalesce(p["v"].cast("long").cast("string"), F.lit("-"))))
    return rows.select("issue_id", "metric", "unit", F.array_join(shown, ",").alias("series"))


@query("series_registry", f"""
WITH {ISSUES},
reg(visual_type, cats, chart, unit) AS (VALUES ('kr_base_rate', ['RATE'], 'step', '%'), ('us_policy_rate', ['RATE'], 'step', '%'),
 ('us_10y', ['RATE', 'MARKET'], 'line', '%'), ('us_cpi_yoy', ['MACRO'], 'line', '%'), ('kr_cpi_yoy', ['MACRO'], 'line', '%'),
 ('usdkrw', ['FX'], 'line', '원'), ('wti', ['COMMODITY'], 'line', '달러'), ('earnings_quarterly', ['EARNINGS'], 'bar', ''), ('kospi_close', ['MARKET'], 'line', 'pt')),
req AS (SELECT id, category, CASE WHEN len(keys) = 0 THEN 'us_10y' WHEN origin = 'cluster' THEN 'usdkrw' ELSE 'earnings_quarterly' END AS visual_type FROM issues)
SELECT id, req.visual_type, chart, unit, (SELECT string_agg(r2.visual_type, ',' ORDER BY list_position(['kr_base_rate','us_policy_rate','us_10y','us_cpi_yoy','kr_cpi_yoy','usdkrw','wti','earnings_quarterly','kospi_close'], r2.visual_type))
  FROM reg r2 WHERE list_contains(r2.cats, req.category)) AS allowed
FROM req JOIN reg ON reg.visual_type = req.visual_type AND list_contains(cats, category)""")
def series_registry(spark: SparkSession, sf: str) -> DataFrame:
    asked = F.when(F.size("keys") == 0, "us_10y").when(F.col("origin") == "cluster", "usdkrw").otherwise("earnings_quarterly")
    rows = G.resolve_visual(issues(spark, sf).withColumn("visual_type", asked))
    return rows.select("id", "visual_type", "visual.chart", "visual.unit", F.array_join(G.allowed_visuals("category"), ",").alias("allowed"))


@query("series_freshness", """
WITH c AS (SELECT event_type || user_id AS cache_key, value, ts AS fetched_at, event_id,
   CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS n FROM events),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY n DESC, fetched_at DESC) AS rn FROM c) WHERE rn = 1)
SELECT cache_key, value FROM l WHERE fetched_at + INTERVAL 6 HOUR >= TIMESTAMP '2024-01-30 12:00:00'""")
def series_freshness(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "events").select(
        F.concat("event_type", F.col("user_id").cast("string")).alias("cache_key"), "value",
        F.col("ts").cast("timestamp").alias("fetched_at"), "event_type")
    newer = F.col("event_type").isin("click", "view")
    cache = G.put_cache(c.filter(~newer).drop("event_type"), c.filter(newer).drop("event_type"))
    return G.fresh_cache(cache, F.lit("2024-01-30 12:00:00").cast("timestamp"), 6).select("cache_key", "value")


@query("observation_rows", """
SELECT CAST(user_id AS VARCHAR) AS series_id, strftime(ts, '%Y-%m-%d') AS ts, value FROM events WHERE event_type NOT IN ('error', 'view')""")
def observation_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Observation payloads, one per event; errors carry a dot and views nothing."""
    e = table(spark, sf, "events")
    told = F.when(F.col("event_type") == "error", ".").when(F.col("event_type") == "view", "").otherwise(F.col("value").cast("string"))
    point = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), told.alias("value"))
    p = e.select(F.col("user_id").cast("string").alias("series_id"), F.to_json(F.struct(F.array(point).alias("observations"))).alias("payload"))
    return payloads.observations(p).withColumn("ts", F.date_format("ts", "yyyy-MM-dd"))


@query("statistics_rows", """
SELECT CAST(user_id AS VARCHAR) AS series_id, strftime(ts, '%Y%m') AS time, value FROM events WHERE event_type NOT IN ('error', 'view')""")
def statistics_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    told = F.when(F.col("event_type") == "error", "-").otherwise(F.col("value").cast("string"))
    row = F.struct(F.when(F.col("event_type") != "view", F.date_format("ts", "yyyyMM")).alias("TIME"), told.alias("DATA_VALUE"))
    body = F.struct(F.struct(F.array(row).alias("row")).alias("StatisticSearch"))
    p = e.select(F.col("user_id").cast("string").alias("series_id"), F.to_json(body).alias("payload"))
    return payloads.statistics(p)


@query("index_closes", """
SELECT CAST(user_id AS VARCHAR) AS series_id, strftime(ts, '%Y-%m-%d') AS t, value FROM events WHERE event_type <> 'error'""")
def index_closes(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    told = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    item = F.struct(F.date_format("ts", "yyyyMMdd").alias("basDt"), told.alias("clpr"))
    body = F.struct(F.struct(F.struct(F.struct(F.array(item).alias("item")).alias("items")).alias("body")).alias("response"))
    p = e.select(F.col("user_id").cast("string").alias("series_id"), F.to_json(body).alias("payload"))
    return payloads.index_closes(p).withColumn("t", F.date_format("t", "yyyy-MM-dd"))


RATE_SQL = f"""
{EVENTS_OBS}, {LAG},
c AS (SELECT *, strftime(ts, '%Y-%m') AS period FROM lagged WHERE abs(value - prev_value) >= 0.05 AND value <> prev_value)
"""


@query("rate_events", f"""
WITH {RATE_SQL}
SELECT 'fred_' || series_id || '_' || strftime(ts, '%Y-%m-%d') AS key, tie, '미 연준 기준금리 변동 (' || printf('%.2f', value) || '%)' AS title, period,
  value, prev_value AS prev, CAST(round((value - prev_value) * 100) AS DOUBLE) AS change, 'bp' AS unit FROM c
UNION ALL
SELECT 'ecos_' || series_id || '_' || strftime(ts, '%Y-%m-%d'), tie, '한국은행 기준금리 ' || CASE WHEN value < prev_value THEN '인하' ELSE '인상' END || ' (' || printf('%.2f', value) || '%)', period,
  value, prev_value, round(abs(value - prev_value), 4), '%p' FROM c""")
def rate_events(spark: SparkSession, sf: str) -> DataFrame:
    """Level changes as event documents in both published forms."""
    changes = G.level_changes(_events(spark, sf), 0.05).withColumn("entity", F.col("series_id"))
    parts = []
    for korean in (False, True):
        docs = G.rate_events(changes.withColumn("series_id", F.concat_ws("#", "series_id", F.col("tie").cast("string"))), korean)
        parts.append(docs)
    rows = parts[0].unionByName(parts[1])
    tie = F.regexp_extract("key", r"#(\d+)_", 1).cast("long")
    level, change = F.col("anchors")[0], F.col("anchors")[1]
    return rows.select(
        F.regexp_replace("key", r"#\d+", "").alias("key"), tie.alias("tie"), "title", "period", level["value"].alias("value"),
        level["prev"].alias("prev"), change["value"].alias("change"), change["unit"].alias("unit"))


@query("macro_events", f"""
WITH {ORDERS_OBS}, {LAG},
c AS (SELECT *, strftime(ts, '%Y-%m') AS period FROM lagged WHERE date_trunc('month', ts) <> date_trunc('month', prev_ts) AND ts >= TIMESTAMP '2000-01-01')
SELECT 'fred_' || series_id || '_' || strftime(ts, '%Y-%m-%d') AS key, '미국 CPI ' || period || ' 발표' AS title, 'CPI(YoY%)' AS metric, value, CAST(NULL AS DOUBLE) AS prev FROM c
UNION ALL SELECT 'ecos_' || series_id || '_' || strftime(ts, '%Y-%m-%d'), '한국 소비자물가 ' || period || ' 발표', '소비자물가지수', value, prev_value FROM c""")
def macro_events(spark: SparkSession, sf: str) -> DataFrame:
    new = G.new_periods(_orders(spark, sf), F.lit("2000-01-01").cast("timestamp"), unit="day").withColumn("entity", F.col("series_id"))
    rows = G.macro_events(new, False).unionByName(G.macro_events(new, True))
    a = F.col("anchors")[0]
    return rows.select("key", "title", a["metric"].alias("metric"), a["value"].alias("value"), a["prev"].alias("prev"))
