"""Scoring, gates, series and events with exact expected numbers."""

import datetime as dt

from pyspark.sql import functions as F

from issueloom.operators import events as V, lifecycle as L, readmodel as R, series as G
from issueloom.operators.evaluation import best_tau, sweep
from issueloom.settings import Settings

NOW = dt.datetime(2026, 7, 10, 12)
S = Settings()


def now():
    return F.lit(str(NOW)).cast("timestamp")


def issue_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, category string, status string, origin string, keys array<string>, seen_sources long, last_update timestamp")


def test_importance(spark):
    day = dt.timedelta(days=1)
    issues = issue_rows(spark, [
        ("rate", "RATE", "active", "official_event", ["BOK"], 3, NOW), ("old", "RATE", "stale", "official_event", ["BOK"], 3, NOW - 3 * day),
        ("firm", "EARNINGS", "active", "cluster", ["SAM"], 9, NOW), ("big", "MARKET", "active", "cluster", [], 0, NOW),
        ("gone", "RATE", "archived", "cluster", [], 0, NOW), ("ancient", "ETC", "candidate", "cluster", [], 0, NOW - 60 * day)])
    anchors = spark.createDataFrame([("big", "일일 상승률", 90.0), ("rate", "변동폭", 25.0), ("rate", "기준금리", 3.0)], "issue_id string, metric string, value double")
    articles = spark.createDataFrame([("firm", "official", False), ("big", "official", True)], "issue_id string, tier string, is_dup boolean")
    got = {r.id: r.importance for r in L.importance(issues, anchors, articles, {"BOK": "institutions", "SAM": "kr_companies"}, now(), S).collect()}
    assert got == {"rate": 100 + 30 + 15 + 10 + 10, "old": 100 + 30 + 15 + 10 - 15, "firm": 40 + 25 + 25 + 10, "big": 55 + 40, "ancient": 0}


def test_ageing(spark):
    h = lambda n: NOW - dt.timedelta(hours=n)
    rows = issue_rows(spark, [(s + str(n), "ETC", s, "cluster", [], 0, h(n)) for s in ("active", "stale", "candidate") for n in (71, 73, 721)])
    got = {r.id: r.s for r in rows.select("id", L.aged_status(now(), S).alias("s")).collect()}
    assert got == {"active71": "active", "active73": "stale", "active721": "archived", "stale71": "stale", "stale73": "stale",
                   "stale721": "archived", "candidate71": "candidate", "candidate73": "candidate", "candidate721": "archived"}


def test_publish_gate(spark):
    rows = [("model", "English title", "ETC", []), ("english", "English title here", "RATE", ["A"]), ("empty", "한글 제목", "ETC", []),
            ("anchored", "한글 제목", "ETC", []), ("two", "한글 제목", "RATE", ["A"]), ("one", "한글 제목", "RATE", ["A"])]
    issues = spark.createDataFrame(rows, "id string, canonical_title string, category string, keys array<string>")
    summaries = spark.createDataFrame([("model", None, "m"), ("one", "", "template")], "issue_id string, title string, model string")
    anchors = spark.createDataFrame([("anchored",), ("english",)], "issue_id string")
    sources = spark.createDataFrame([("two", 2), ("one", 1)], "issue_id string, seen_sources long")
    got = {r.id: r.publish for r in R.publishable(issues, summaries, anchors, sources).collect()}
    assert got == {"model": True, "english": False, "empty": False, "anchored": True, "two": True, "one": False}


def test_chart_consistency(spark):
    rows = [("same", "국제 유가", 80.0, "official", "2026-07", 81.0, True), ("off", "국제 유가", 80.0, "official", "2026-07", 120.0, False),
            ("press", "국제 유가", 80.0, "press", "2026-07", 120.0, True), ("other", "환율", 80.0, "official", "2026-07", 120.0, True),
            ("past", "국제 유가", 111.0, "official", "2026-03", 80.0, True), ("day", "국제 유가", 80.0, "official", "2026-07-03", 120.0, False)]
    df = spark.createDataFrame(rows, "id string, metric string, value double, trust string, period string, last double, want boolean")
    a = F.struct("metric", "value", "trust", "period")
    words = F.array(F.lit("유가"), F.lit("WTI"))
    got = df.withColumn("a", a).select("id", "want", R.consistent(F.col("a"), words, F.lit(0.12), F.lit("2026-07"), F.col("last")).alias("x"))
    assert all(r.x == r.want for r in got.collect())


def test_headline_stat_texts(spark):
    t = lambda d: NOW - dt.timedelta(days=d)
    rows = [("i", "한국은행", "기준금리", 3.0, "%", 3.25, "official", "p", t(1), 1), ("i", "한국은행", "변동폭", 0.25, "%p", None, "official", "p", t(0), 2),
            ("j", "S", "매출", 1234567.0, "억원", None, "official", "p", t(0), 3), ("k", "X", "값", 5.0, "원", 5.0, "official", "p", t(0), 4)]
    a = spark.createDataFrame(rows, "issue_id string, entity string, metric string, value double, unit string, prev double, trust string, period string, observed_at timestamp, seq long")
    got = {r.issue_id: r for r in R.headline_stat(a).collect()}
    assert (got["i"].value, got["i"].delta_text, got["i"].prev_text, got["i"].direction) == ("3", "-0.25%p", "직전 3.25%", "down")
    assert (got["j"].value, got["j"].delta_text, got["j"].direction) == ("1,234,567", None, "flat")
    assert (got["k"].delta_text, got["k"].direction) == ("±0원", "flat")


def test_level_changes_and_periods(spark):
    rows = [("r", dt.datetime(2026, 1, d), v, d) for d, v in ((1, 3.5), (2, 3.5), (3, 3.52), (4, 3.25))] + [("r", dt.datetime(2026, 2, 1), 3.25, 9)]
    obs = spark.createDataFrame(rows, "series_id string, ts timestamp, value double, tie long")
    got = G.level_changes(obs, 0.05).collect()
    assert [(r.tie, r.prev_value, r.delta_bp, r.delta_points) for r in got] == [(4, 3.52, -27, 0.27)]
    assert [r.tie for r in G.new_periods(obs, F.lit("2026-01-15").cast("timestamp")).collect()] == [9]
    assert {r.tie for r in G.level_changes(obs, 0.0).collect()} == {3, 4}


def test_sweep(spark):
    pairs = spark.createDataFrame([(0.9, True), (0.85, True), (0.5, False)], "sim double, same boolean")
    table = sweep(pairs, 0.8, 0.9, 0.1)
    got = {r.tau: r for r in table.collect()}
    assert (got[0.8].tp, got[0.8].fp, got[0.8].fn, got[0.8].f1) == (2, 0, 0, 1.0)
    assert (got[0.9].tp, got[0.9].fn, got[0.9].recall) == (1, 1, 0.5)
    assert best_tau(table).collect()[0].tau == 0.8


def test_events_upsert_and_repeat(spark):
    schema = ("key string, created_at timestamp, category string, entity string, period string, title string, "
              "anchors array<struct<entity:string,metric:string,value:double,unit:string,prev:double,period:string,source:string,observed_at:timestamp>>")
    def doc(key, value, at):
        return (key, at, "EARNINGS", "삼성전자", "2026-1Q", "실적", [("삼성전자", "매출액", value, "억원", None, "2026-1Q", "DART", None)])
    first = spark.createDataFrame([doc("k1", 10.0, NOW), doc("k2", 12.0, NOW + dt.timedelta(hours=1))], schema)
    stored = spark.createDataFrame([], "id string, anchor_key string, status string, last_update timestamp, created_at timestamp")
    done = spark.createDataFrame([("k0",)], "key string")
    linked = V.link_events(V.pending(first, done), stored)
    issues = V.upsert_issues(linked, stored, now(), [("삼성전자", "SAM")]).collect()
    assert len(issues) == 1 and issues[0].id[0] == "e" and issues[0]["keys"] == ["SAM"] and issues[0].status == "active"
    empty = spark.createDataFrame([], "issue_id string, entity string, metric string, value double, unit string, period string, source string, trust string, prev double, observed_at timestamp, seq long")
    anchors = V.upsert_anchors(empty, V.event_anchors(linked, now())).collect()
    assert [(a.value, a.trust) for a in anchors] == [(12.0, "official")]
    assert V.pending(first, spark.createDataFrame([("k1",), ("k2",)], "key string")).count() == 0


def test_archived_issue_keeps_its_events(spark):
    ak = "E|RATE|p"
    stored = spark.createDataFrame([("x", ak, "archived", NOW, NOW)], "id string, anchor_key string, status string, last_update timestamp, created_at timestamp")
    ev = spark.createDataFrame([("k", NOW, "RATE", "E", "p", "t")], "key string, created_at timestamp, category string, entity string, period string, title string")
    derived = V.link_events(ev, stored).collect()[0].issue_id
    again = stored.withColumn("id", F.lit(derived))
    linked = V.link_events(ev, again)
    rows = V.upsert_issues(linked, again, now(), []).collect()
    assert linked.collect()[0].issue_id == derived and len(rows) == 1 and rows[0].status == "archived"
