"""Text, URL and number rules on literal rows, as columns of one DataFrame each."""

import pytest
from pyspark.sql import functions as F

from issueloom.functions import text as X
from issueloom.functions.simhash import hamming, simhash64


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_canonical_url(spark):
    cases = {
        "HTTPS://Ex.com/A?utm_source=x&b=2#top": "https://ex.com/A?b=2",
        " http://a.com/p?REF=1&gclid=2 ": "http://a.com/p",
        "http://a.com/p?x=&y": "http://a.com/p?x=&y=",
        "http://a.com/p?q=a%20b&u=http://z": "http://a.com/p?q=a+b&u=http%3A%2F%2Fz",
        "": "",
    }
    assert column(spark, list(cases), X.canonical_url) == list(cases.values())


def test_scripts(spark):
    cases = {"한국은행 기준금리": False, "Fed raises rates": False, "美 연준 금리": False, "日本銀行が利上げ": True,
             "中国经济增长放缓": True, "中美 trade": False, "经济 A": True, "": False}
    assert column(spark, list(cases), X.is_foreign) == list(cases.values())
    assert column(spark, ["美·中 무역", "佛蘭西 대선", "日本銀行", "plain"], X.hanja_to_hangul) == ["미국·중국 무역", "프랑스 대선", "일본銀行", "plain"]


def test_numbers(spark):
    tags = column(spark, ["기준금리 0.25%p 인하, 3조 원", "25bp 올라 1,450원", "none"], X.number_tags)
    assert tags == [["0.25%p", "3조원"], ["25bp", "1,450원"], []]
    numbers = column(spark, ["2026-07 3.50% 1,234.5", "x 5 5.0"], lambda c: F.array_sort(X.numbers_in(c)))
    assert numbers == [[-7.0, 3.5, 1234.5, 2026.0], [5.0]]


def test_times(spark):
    given = ["Tue, 09 Jan 2024 12:04:05 +0900", "09 Jan 2024 03:04:05 GMT", "2024-01-09T03:04:05Z", "2024-01-09 03:04:05", "soon", ""]
    shown = column(spark, given, lambda c: F.date_format(X.parse_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert shown == ["2024-01-09 03:04:05"] * 4 + [None, None]


def test_entities_prefer_long_aliases_and_guard_short_ones(spark):
    aliases = [("SK", "SK"), ("SK하이닉스", "HYNIX"), ("연준", "FED"), ("Fed", "FED")]
    got = column(spark, ["SK하이닉스 실적", "risky asks", "the sk group, FED and 연준", "세미연준"], lambda c: X.entity_keys(c, aliases))
    assert got == [["HYNIX", "SK"], [], ["FED", "SK"], ["FED"]]


def test_glossary_takes_leftmost_then_longest(spark):
    surfaces = {"금리": "금리", "기준금리": "기준금리", "금리 인하": "금리 인하", "CPI": "CPI", "물가지수": "CPI", "x": "x"}
    got = column(spark, ["기준금리 인하와 금리", "cpi 물가지수 x", "없음"], lambda c: X.glossary_terms(c, surfaces))
    assert got == [["기준금리", "금리"], ["CPI"], []]


def test_clipping(spark):
    assert column(spark, ["short", "Walmart Debunks Three Myths About", "a" * 30], lambda c: X.clip(c, 22)) == [
        "short", "Walmart Debunks…", "a" * 21 + "…"]
    long = "가" * 40 + ", " + "나" * 30
    assert column(spark, [long, "짧아요"], lambda c: X.clip_sentence(c, 55)) == ["가" * 40 + "요.", "짧아요"]
    assert column(spark, ["금리", "환율", "GDP", ""], lambda c: X.particle(c, "이", "가")) == ["가", "이", "가", "가"]


def test_display_number(spark):
    assert column(spark, [3.0, 1234567.0, 0.25, 10.5, -1.256], X.display_number, "double") == ["3", "1,234,567", "0.25", "10.5", "-1.26"]


def test_period_and_keys(spark):
    rows = spark.createDataFrame([("분기보고서 (2026.03)", "20260515"), ("사업보고서", "20261103")], "n string, d string")
    assert [r.p for r in rows.select(X.period_bucket("n", "d").alias("p")).collect()] == ["2026-1Q", "2026-4Q"]
    assert column(spark, ["a/b c:한글"], X.safe_key) == ["a_b_c_한글"]


def test_json_rescue(spark):
    got = column(spark, ['{"a": 1}', 'x {"a": 1} y', "no", "{bad"], X.rescued_json)
    assert got == ['{"a": 1}', '{"a": 1}', None, None]


def test_simhash_separates_copies_from_others(spark):
    rows = spark.createDataFrame([("한국은행, 기준금리 인하", "한국은행 기준금리 인하.", "삼성전자 2분기 영업이익 돌파")], "a string, b string, c string")
    r = rows.select(hamming(simhash64("a"), simhash64("b")).alias("near"), hamming(simhash64("a"), simhash64("c")).alias("far")).first()
    assert r.near <= 3 < r.far


def test_union_of_very_many_terms(spark):
    """Names are computed once for a text, not once for each of its terms; nulls and repeated names as ever."""
    import time

    from pyspark.sql import functions as F

    from issueloom.operators.glossary import union_terms

    kind = "array<struct<term:string,easy:string,example:string>>"
    give = lambda words: [(w, "", "") for w in words]
    many = [f"W{i % 9000}" for i in range(18_000)]
    rows = [(1, give(["B ", None, "a"]), give(["A", "b", " ", None, "c", "C ", "d"])), (2, give([" ", "x"]), give([])), (3, give(["w7"]), give(many)), (4, None, give(["x"]))]
    df = spark.createDataFrame(rows, f"id int, s {kind}, g {kind}")
    began = time.time()
    got = {r.id: r.t for r in df.select("id", F.transform(union_terms(F.col("s"), F.col("g")), lambda g: g["term"]).alias("t")).collect()}
    assert got == {1: ["B ", "a", "c", "d"], 2: [" ", "x"], 3: ["w7"] + [w for w in many[:9000] if w != "W7"], 4: None}
    assert time.time() - began < 15
