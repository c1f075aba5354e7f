"""Validation of generated summaries: one valid row and one change per rule."""

import pytest
from pyspark.sql import functions as F

from issueloom.operators import summary as Y

GOOD = {
    "title": "한은 금리 인하", "one_liner": "기준금리가 3.25%에서 3.0%로 내렸어요", "why_now": "대출 이자가 달라져요",
    "impact_line": "이자 부담이 줄어요",
    "details": ["한국은행이 기준금리를 내렸어요", "낙폭은 0.25%p 였어요", "시장은 예상한 결과로 받아들였어요"],
    "visual_type": "kr_base_rate", "effects": ["대출 금리가 낮아질 수 있어요!"],
    "glossary": [{"term": "기준금리", "easy": "돈값의 기준이에요", "example": "x"}],
}
SCHEMA = "name string, out struct<" + Y.GENERATED.replace("title string", "title:string", 1).replace(
    "one_liner string", "one_liner:string").replace("why_now string", "why_now:string").replace("impact_line string", "impact_line:string").replace(
    "details array", "details:array").replace("visual_type string", "visual_type:string").replace("effects array", "effects:array").replace(
    "glossary array", "glossary:array") + ">"

CHANGES = {
    "good": ({}, []),
    "title missing": ({"title": " "}, ["title missing"]),
    "title long": ({"title": "가" * 23}, ["title over 22: 23"]),
    "title han": ({"title": "美 금리"}, ["title has Han or kana"]),
    "one rude": ({"one_liner": "기준금리 인하"}, ["one_liner not polite"]),
    "one long": ({"one_liner": "가" * 50 + "요"}, ["one_liner over 50: 51"]),
    "why missing": ({"why_now": None}, ["why_now missing"]),
    "few details": ({"details": ["하나예요", "둘이에요"]}, ["fewer than 3 details"]),
    "same details": ({"details": ["같은 문장이에요"] * 4}, ["fewer than 3 details"]),
    "rude detail": ({"details": ["하나예요", "둘이에요", "셋이다"]}, ["details not polite: 2"]),
    "visual": ({"visual_type": "wti"}, ["visual not allowed: wti"]),
    "effects none": ({"effects": []}, ["effects not 1 or 2"]),
    "effects calm": ({"effects": ["이자가 줄어요"]}, ["effects not exclaimed: 0"]),
    "effects repeat": ({"effects": ["한국은행이 기준금리를 내렸어요!"]}, ["effects repeat details"]),
    "number": ({"why_now": "금리가 7.77%예요"}, ["numbers without source: 7.77"]),
    "free numbers": ({"why_now": "2026년 12월이에요"}, []),
    "basis points": ({"why_now": "25bp 내렸어요"}, []),
    "banned": ({"why_now": "무조건 올라요"}, ["banned: 무조건"]),
    "long impact": ({"impact_line": "가" * 50 + "요"}, []),
}


def test_every_rule(spark):
    rows = [(name, tuple({**GOOD, **change}[k] if k != "glossary" else [tuple(g.values()) for g in GOOD["glossary"]] for k in GOOD))
            for name, (change, _) in CHANGES.items()]
    anchor = F.array(F.struct(F.lit(3.0).alias("value"), F.lit(3.25).alias("prev")))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("facts_json", F.lit('{"v": 3.0, "p": 3.25}')).withColumn(
        "anchors", anchor).withColumn("allowed_visuals", F.array(F.lit("kr_base_rate")))
    got = {r.name: r for r in Y.validate(df).collect()}
    for name, (_, errors) in CHANGES.items():
        assert got[name].errors == errors, name
    assert got["good"].glossary[0].term == "기준금리" and got["good"].impact_line == "이자 부담이 줄어요"
    assert got["long impact"].impact_line is None


def test_no_object_is_rejected(spark):
    df = spark.createDataFrame([("x", "no json at all")], "issue_id string, text string")
    rows = Y.parse_generated(df, "text").withColumn("facts_json", F.lit("{}")).withColumn(
        "anchors", F.array().cast("array<struct<value:double,prev:double>>")).withColumn("allowed_visuals", F.array().cast("array<string>"))
    assert "output is no JSON object" in Y.validate(rows).collect()[0].errors
