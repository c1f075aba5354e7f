"""Time-series jobs on long tables (series_id, ts, value, tie)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..settings import AUXILIARY_METRIC, VISUALS
from .ordered import latest_per_key, top_n, with_previous


def level_changes(obs: DataFrame, min_delta: float, unit: str = "minute") -> DataFrame:
    """Observations that differ from the one before by at least min_delta (any difference when 0).

    Both published forms of the change come along: signed basis points and absolute points.
    """
    rows = with_previous(obs, "series_id", "ts", "tie", ["value"], unit)
    delta = F.col("value") - F.col("prev_value")
    moved = (F.abs(delta) >= min_delta) & (delta != 0)
    return rows.filter(moved).withColumn("delta_bp", F.round(delta * 100).cast("long")).withColumn(
        "delta_points", F.round(F.abs(delta), 4)
    )


def new_periods(obs: DataFrame, since: Column, unit: str = "minute", period: str = "month") -> DataFrame:
    """Observations whose month differs from the one before, from `since` on."""
    rows = with_previous(obs, "series_id", "ts", "tie", ["ts", "value"], unit)
    changed = F.date_trunc(period, "ts") != F.date_trunc(period, "prev_ts")
    return rows.filter(changed & (F.col("ts") >= since)).withColumn("period", F.date_trunc(period, "ts"))


def latest_state(obs: DataFrame) -> DataFrame:
    """Last observation per series: the point a later run continues from."""
    last = F.max_by(F.struct("ts", "value"), F.struct("ts", "tie")).alias("s")
    return obs.groupBy("series_id").agg(last).select("series_id", F.col("s.ts").alias("ts"), F.col("s.value").alias("value"))


ANCHOR = (
    "struct<entity:string,metric:string,value:double,unit:string,prev:double,period:string,source:string,observed_at:timestamp>"
)


def _anchor(entity, metric: str, value: Column, unit: str, prev: Column, period: Column, source: str) -> Column:
    return F.struct(
        entity.alias("entity"), F.lit(metric).alias("metric"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
        prev.cast("double").alias("prev"), period.alias("period"), F.lit(source).alias("source"),
        F.lit(None).cast("timestamp").alias("observed_at"),
    ).cast(ANCHOR)


def rate_events(changes: DataFrame, korean: bool) -> DataFrame:
    """Event documents of level changes (series_id, entity, ts, value, prev_value, delta_bp, delta_points).

    One agency reports the signed change in basis points, the other the absolute change in points.
    """
    period, none = F.date_format("ts", "yyyy-MM"), F.lit(None).cast("double")
    shown = F.format_string("%.2f", "value")
    if korean:
        entity, source, stem = F.lit("한국은행"), "ECOS", "ecos_"
        title = F.concat(F.lit("한국은행 기준금리 "), F.when(F.col("value") < F.col("prev_value"), "인하").otherwise("인상"), F.lit(" ("), shown, F.lit("%)"))
        change = _anchor(entity, AUXILIARY_METRIC, F.col("delta_points"), "%p", none, period, source)
        line = F.concat(F.lit("한국은행 기준금리 "), shown, F.lit("% ("), period, F.lit(")"))
        url = F.lit("https://ecos.bok.or.kr")
    else:
        entity, source, stem = F.col("entity"), "FRED", "fred_"
        title = F.concat(F.lit("미 연준 기준금리 변동 ("), shown, F.lit("%)"))
        change = _anchor(entity, AUXILIARY_METRIC, F.col("delta_bp"), "bp", none, period, source)
        line = F.concat_ws(" ", F.lit("FRED"), "series_id", F.date_format("ts", "yyyy-MM-dd"), F.lit("="), F.col("value").cast("string"))
        url = F.concat(F.lit("https://fred.stlouisfed.org/series/"), "series_id")
    level = _anchor(entity, "기준금리", F.col("value"), "%", F.col("prev_value"), period, source)
    return _documents(changes, stem, "RATE", F.col("entity"), period, title, F.array(level, change), line, source, url)


def macro_events(periods: DataFrame, korean: bool) -> DataFrame:
    """Event documents of newly published periods (series_id, entity, ts, value, prev_value)."""
    period, none = F.date_format("ts", "yyyy-MM"), F.lit(None).cast("double")
    if korean:
        title = F.concat(F.lit("한국 소비자물가 "), period, F.lit(" 발표"))
        anchor = _anchor(F.lit("KR"), "소비자물가지수", F.col("value"), "", F.col("prev_value"), period, "ECOS")
        line = F.concat(F.lit("ECOS 소비자물가 "), F.date_format("ts", "yyyyMM"), F.lit(" 신규 관측"))
        return _documents(periods, "ecos_", "MACRO", F.col("entity"), period, title, F.array(anchor), line, "ECOS", F.lit("https://ecos.bok.or.kr"))
    title = F.concat(F.lit("미국 CPI "), period, F.lit(" 발표"))
    anchor = _anchor(F.col("entity"), "CPI(YoY%)", F.col("value"), "%", none, period, "FRED")
    line = F.concat_ws(" ", F.lit("FRED"), "series_id", F.date_format("ts", "yyyy-MM-dd"), F.lit("신규 관측"))
    url = F.concat(F.lit("https://fred.stlouisfed.org/series/"), "series_id")
    return _documents(periods, "fred_", "MACRO", F.col("entity"), period, title, F.array(anchor), line, "FRED", url)


def _documents(rows, stem, category, entity, period, title, anchors, line, source, url) -> DataFrame:
    """Columns of an event document; the key names series and day, the original date is kept."""
    return rows.select(
        F.concat(F.lit(stem), "series_id", F.lit("_"), F.date_format("ts", "yyyy-MM-dd")).alias("key"),
        F.col("ts").alias("created_at"), F.lit(category).alias("category"), entity.alias("entity"), period.alias("period"),
        title.alias("title"), anchors.alias("anchors"),
        F.struct(F.lit("official").alias("kind"), line.alias("title"), F.lit(source).alias("source"), url.alias("url")).alias("timeline"),
    )


def month_end(obs: DataFrame) -> DataFrame:
    return obs.groupBy("series_id", F.date_trunc("month", "ts").alias("month")).agg(
        F.max_by("value", F.struct("ts", "tie")).alias("value")
    )


def year_over_year(monthly: DataFrame) -> DataFrame:
    """Percent change to the same month a year before; months without a base are left out."""
    base = monthly.select(
        "series_id", F.add_months(F.col("month"), 12).cast("timestamp").alias("month"), F.col("value").alias("base")
    )
    return monthly.join(base, ["series_id", "month"]).filter(F.col("base") != 0).select(
        "series_id", "month", "value", F.round((F.col("value") / F.col("base") - 1) * 100, 2).alias("yoy")
    )


def last_points(obs: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    return top_n(obs, ["series_id"], [F.col(ts).desc()], n)


def merge_series(stored: DataFrame, batch: DataFrame, keep: int = 120) -> DataFrame:
    """Stored points replaced by newer ones of the same day, the last `keep` days per series."""
    both = stored.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)))
    current = latest_per_key(both, ["series_id", "t"], [F.col("_batch").desc(), F.col("tie").desc()]).drop("_batch")
    return last_points(current, keep, "t").drop("rn")


def quarterly_groups(anchors: DataFrame, periods: int = 4) -> DataFrame:
    """Per issue and metric the last periods in order, one value each, with the issue's last non-empty unit."""
    usable = anchors.filter(F.col("metric") != AUXILIARY_METRIC)
    unit = usable.filter(F.col("unit") != "").groupBy("issue_id").agg(
        F.max_by("unit", F.struct("period", "seq")).alias("unit")
    )
    current = usable.groupBy("issue_id", "metric", "period").agg(F.max_by("value", "seq").alias("value"))
    recent = top_n(current, ["issue_id", "metric"], [F.col("period").desc()], periods)
    grouped = recent.groupBy("issue_id", "metric").agg(
        F.array_sort(F.collect_list(F.struct(F.col("period").alias("t"), F.col("value").alias("v")))).alias("series")
    )
    return grouped.join(unit, "issue_id", "left").withColumn("unit", F.coalesce("unit", F.lit("")))


def registry() -> Column:
    """The chart registry as an array of structs; fixed configuration of a few rows."""
    rows = []
    for kind, cats, chart, unit, source, months, words, tol in VISUALS:
        rows.append(F.struct(
            F.lit(kind).alias("type"), F.array(*[F.lit(c) for c in cats]).alias("cats"), F.lit(chart).alias("chart"),
            F.lit(unit).alias("unit"), F.lit(source).alias("source"), F.lit(months).cast("int").alias("months"),
            (F.array(*[F.lit(w) for w in words]) if words else F.lit(None).cast("array<string>")).alias("words"),
            F.lit(tol).cast("double").alias("tol"),
        ))
    return F.array(*rows)


def allowed_visuals(category) -> Column:
    """Chart types a category may request, in registry order."""
    c = F.col(category) if isinstance(category, str) else category
    return F.transform(F.filter(registry(), lambda r: F.array_contains(r["cats"], c)), lambda r: r["type"])


def resolve_visual(requests: DataFrame) -> DataFrame:
    """Requests (…, visual_type, category) with their registry entry; outside the category nothing is built."""
    entry = F.element_at(
        F.filter(registry(), lambda r: (r["type"] == F.col("visual_type")) & F.array_contains(r["cats"], F.col("category"))), 1
    )
    found = F.filter(registry(), lambda r: (r["type"] == F.col("visual_type")) & F.array_contains(r["cats"], F.col("category")))
    return requests.filter(F.size(found) > 0).withColumn("visual", entry)


def fresh_cache(cache: DataFrame, now: Column, hours: int) -> DataFrame:
    return cache.filter(F.col("fetched_at") + F.expr(f"INTERVAL {hours} HOURS") >= now)


def put_cache(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    both = cache.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    return latest_per_key(both, ["cache_key"], [F.col("_new").desc(), F.col("fetched_at").desc()]).drop("_new")
