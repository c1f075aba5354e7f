"""Detail documents with terms and charts, steady topics, and the index that carries them."""

import datetime as dt
import json

import numpy as np
from pyspark.sql import functions as F

from issueloom.functions import vectors as X
from issueloom.operators import readmodel as R
from issueloom.plans import cycle as C
from issueloom.plans.state import empty_state, save_state, shaped

NOW = dt.datetime(2031, 5, 6, 7)
REFS = "array<struct<phrase:string,issue_id:string,anchor_key:string>>"
TOPIC = ("id string, pos int, icon string, title string, one_liner string, status_note string, impact array<string>, columns array<string>, "
         "cells array<array<string>>, visual_type string, rule array<struct<categories:array<string>,keywords:array<string>,entities:array<string>,issue_id:string,anchor_key:string>>")


def issues(spark):
    rows = [("i1", "Base rate 中 rises", "RATE", "active", 9, ["K1"], "ev1", NOW), ("i2", "Base rate again", "RATE", "stale", 8, ["K1", "K2"], None, NOW - dt.timedelta(days=1)),
            ("i3", "Old news", "RATE", "archived", 7, ["K2"], "ev3", NOW), ("i4", "Crown falls", "FX", "active", 6, [], None, NOW)]
    return spark.createDataFrame(rows, "id string, canonical_title string, category string, status string, importance long, keys array<string>, anchor_key string, last_update timestamp").withColumns(
        {"event_at": F.col("last_update"), "created_at": F.col("last_update"), "summary_title": F.lit(None).cast("string")})


def test_glossary_joins_reviewed_and_generated_terms(spark):
    rows = spark.createDataFrame([("i1", "Base rate rises", "A hike by the bank", None, ["the spread widens"]), ("i2", "Nothing", None, None, None), ("i3", "hike", "", "", [])],
                                 "id string, title string, one_liner string, why_now string, details array<string>")
    told = spark.createDataFrame([("i1", [(" Spread ", "other", "x"), ("Tail", "end of it", None), ("", "no name", "")]), ("i2", None)],
                                 "issue_id string, glossary array<struct<term:string,easy:string,example:string>>")
    surfaces = {"base rate": "Base rate", "hike": "Rate hike", "spread": "spread", "unknown": "Gone"}
    terms = {"Base rate": ("what banks pay", "4 %"), "Rate hike": ("it goes up", ""), "spread": ("a gap", "")}
    got = {r.id: [tuple(g) for g in r.glossary] for r in R.with_glossary(rows, told, surfaces, terms).collect()}
    assert got["i1"] == [("Base rate", "what banks pay", "4 %"), ("Rate hike", "it goes up", ""), ("spread", "a gap", ""), ("Tail", "end of it", "")]
    assert got["i2"] == [] and [g[0] for g in got["i3"]] == ["Rate hike"]
    assert [g[0] for g in R.with_glossary(rows, told, {}, {}).filter("id = 'i1'").first().glossary] == ["Spread", "Tail"]


def test_charts_of_issues(spark):
    state = dict(empty_state(spark))
    state["issues"] = shaped(issues(spark), "issues")
    state["summaries"] = shaped(spark.createDataFrame(
        [("i1", "us_10y"), ("i2", "usdkrw"), ("i4", "usdkrw"), ("i3", "none")], "issue_id string, visual_type string"), "summaries")
    series = spark.createDataFrame([("us_10y", [("2031-04", 4.0), ("2031-05", 4.5)]), ("usdkrw", [("2031-05", 1300.0)])], C.NO_SERIES)
    got = {r.issue_id: r for r in C.charts_of(state, series).collect()}
    assert set(got) == {"i1", "i4"}  # the second asks for a chart outside its category
    assert got["i1"].chart == "line" and got["i1"].unit == "%" and [p.v for p in got["i1"].series] == [4.0, 4.5]
    assert C.charts_of(state, None).count() == 0
    earnings = issues(spark).withColumn("category", F.lit("EARNINGS"))
    anchors = [("i1", "Co", m, v, "억원", p, n) for n, (m, v, p) in enumerate([("매출액", 10.0, "2030-4Q"), ("매출액", 12.0, "2031-1Q"), ("영업이익", 2.0, "2031-1Q")])]
    state["issues"], state["anchors"] = shaped(earnings, "issues"), shaped(spark.createDataFrame(
        anchors, "issue_id string, entity string, metric string, value double, unit string, period string, seq long"), "anchors")
    state["summaries"] = shaped(spark.createDataFrame([("i1", "earnings_quarterly"), ("i2", "earnings_quarterly")], "issue_id string, visual_type string"), "summaries")
    bar, = C.charts_of(state, None).collect()  # the other issue has no figures
    assert bar.chart == "bar" and {g.name: [p.v for p in g.series] for g in bar.groups} == {"매출액": [10.0, 12.0], "영업이익": [2.0]} and bar.unit == "억원"
    cards = spark.createDataFrame([("i1", True), ("i2", False)], "id string, has_visual boolean")
    shown = {r.id: r.visual for r in R.with_visual(cards, C.charts_of(state, None)).collect()}
    assert shown["i1"].visual_type == "earnings_quarterly" and shown["i2"] is None
    refused = R.with_visual(cards.withColumn("has_visual", F.lit(False)), C.charts_of(state, None))
    assert all(r.visual is None for r in refused.collect())


def test_topics_and_index(spark):
    rule = lambda **k: [(k.get("categories"), k.get("keywords"), k.get("entities"), k.get("issue_id"), k.get("anchor_key"))]
    rows = [("rates", 1, "R", "Rates", None, "open", ["dear loans", " "], ["a", "b"], [["1", "2"], ["3"]], None, rule(categories=["RATE"], entities=["K2"])),
            ("crown", 0, None, "Crown", "falls", None, None, [], [], None, rule(keywords=["crown"])),
            ("pinned", 2, None, "Pinned", "", None, [], None, None, None, rule(anchor_key="ev1")),
            ("", 3, None, "No id", "", None, [], None, None, None, []), ("untitled", 4, None, "", "", None, [], None, None, None, [])]
    topics = spark.createDataFrame(rows, TOPIC)
    paragraphs = spark.createDataFrame(
        [("rates", 0, "The base rate rises again", [("base rate", "i1", None), ("not there", "i1", None), ("again", None, "ev3"), ("rises", None, "ev1")]),
         ("rates", 1, "", [("x", "i1", None)]), ("rates", 2, "Second", None), ("crown", 0, "Crown falls", [("falls", "i3", None)])],
        f"topic string, pos int, text string, refs {REFS}")
    got = {r.id: r for r in R.topic_documents(topics, paragraphs, issues(spark)).collect()}
    assert set(got) == {"rates", "crown", "pinned"}
    r = got["rates"]
    assert r.latest_issue.id == "i2" and r.impact == ["dear loans"] and [list(x) for x in r.table.rows] == [["1", "2"]]
    assert [(d.text, [tuple(x) for x in d.refs or []]) for d in r.detail] == [("The base rate rises again", [("base rate", "i1"), ("rises", "i1")]), ("Second", [])]
    assert got["crown"].latest_issue.id == "i4" and got["crown"].table is None and got["crown"].detail[0].refs is None
    assert got["pinned"].latest_issue.id == "i1"
    cards = issues(spark).filter("status IN ('active', 'stale')").select("id", "status", "importance", "last_update")
    index = R.index_document(cards, F.lit(NOW), "Sources A and B", R.topic_documents(topics, paragraphs, issues(spark))).first()
    assert index.attribution == "Sources A and B" and [json.loads(t)["id"] for t in index.topics] == ["crown", "rates", "pinned"]
    assert [json.loads(c)["id"] for c in index.issues] == ["i1", "i4", "i2"]
    assert R.index_document(cards, F.lit(NOW), "x").first().topics is None


def test_two_byte_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    v = [rng.normal(size=5).tolist(), [0.0, 6e-8, -65504.0, 1 / 3, 2.0 ** -15], [], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, vec array<float>").coalesce(1)
    rows = {r.i: r for r in df.select("i", X.to_half("vec").alias("b"), X.half_precision("vec").alias("h"), X.from_half(X.to_half("vec")).alias("f")).collect()}
    for i, x in enumerate(v):
        if x is None:
            assert rows[i].b is None and rows[i].h is None and rows[i].f is None
        else:
            want = np.array(x, np.float32).astype(np.float16)
            assert bytes(rows[i].b) == want.tobytes() and rows[i].h == want.astype(np.float32).tolist() == rows[i].f
    state = dict(empty_state(spark))
    state["articles"] = shaped(df.select(F.col("i").cast("long").alias("aid"), "vec", F.lit(NOW).alias("collected_at")), "articles")
    stored = save_state(empty_state(spark), state, str(tmp_path / "s"), 0)
    raw = spark.read.parquet(str(tmp_path / "s/articles"))
    assert dict(raw.dtypes)["vec"] == "binary" and {r.aid: r.vec for r in stored["articles"].collect()} == {i: rows[i].h for i in rows}
