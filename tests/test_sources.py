"""Sources and sinks on small files."""

import json

import numpy as np
from pyspark.sql import functions as F

from issueloom.functions.vectors import half_precision
from issueloom.operators import embed as E, series as G
from issueloom.operators.evaluation import evaluate
from issueloom.operators.readmodel import index_document
from issueloom.settings import Settings
from issueloom.sources import dictionaries as Y, landing, payloads


def ts(text):
    return F.lit(text).cast("timestamp")


def test_raw_reader_prunes_months_and_skips_bad_lines(spark, tmp_path):
    rows = {"2026-05": [{"id": "a", "collected_at": "2026-07-10T11:00:00+00:00"}],
            "2026-07": [{"id": "b", "collected_at": "2026-07-10T11:00:00+00:00"}, {"id": "c", "collected_at": "2026-07-01T00:00:00+00:00"},
                        {"id": "d", "collected_at": "unknown"}, {"id": "e", "collected_at": "2026-07-10 03:00:00"}]}
    for month, items in rows.items():
        folder = tmp_path / f"month={month}"
        folder.mkdir()
        (folder / "x.jsonl").write_text("\n".join([json.dumps(i) for i in items] + ["{broken"]), encoding="utf-8")
    df = landing.read_raw(spark, str(tmp_path), ts("2026-07-10 12:00:00"), ("2026-06", "2026-07"))
    assert {r.id for r in df.collect()} == {"b", "d", "e"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan


def test_append_twice_adds_nothing(spark, tmp_path):
    items = spark.createDataFrame(
        [("http://a/1?utm_source=x", "one", " lead \n text " * 40, 0), ("HTTP://A/1", "again", "", 1), ("http://a/2", " ", "", 2), ("http://a/3", "three", "", 3)],
        "url string, title string, lead string, pos long").select(
            "*", F.lit("s").alias("source"), F.lit(None).cast("timestamp").alias("published_at"), F.lit("ko").alias("lang"))
    none = spark.createDataFrame([], "id string")
    first = landing.new_articles(items, none, "wire", ts("2026-07-10 12:00:00"))
    landing.append_articles(first, str(tmp_path / "raw"))
    stored = spark.read.schema("id string, title string, lead string, month string").json(str(tmp_path / "raw"))
    assert {(r.title, len(r.lead)) for r in stored.collect()} == {("one", 200), ("three", 0)}
    assert landing.new_articles(items, stored.select("id"), "wire", ts("2026-07-10 13:00:00")).count() == 0


def test_feeds(spark):
    rss = ('<rss version="2.0"><channel><item><title>&lt;b&gt;금리&lt;/b&gt; 결정</title><link> http://a/1 </link>'
           "<description>본문 &lt;p&gt;문단&lt;/p&gt;</description><pubDate>Thu, 16 Jul 2026 10:00:00 +0900</pubDate></item>"
           "<item><title>no link</title></item></channel></rss>")
    atom = ('noise<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>8-K - Apple Inc. (0000320193) (Filer)</title>'
            '<link rel="self" href="http://self"/><link rel="alternate" href="http://sec/0000320193-26-000001"/>'
            "<summary>Item 2.02</summary><updated>2026-07-16T01:00:00Z</updated></entry></feed>")
    df = spark.createDataFrame([("r", rss), ("a", atom), ("x", "not a feed"), ("y", "<rss><channel>")], "src string, payload string")
    got = {r.src: r for r in payloads.feed_entries(df).collect()}
    assert set(got) == {"r", "a"}
    assert got["r"].title == "금리 결정" and got["r"].link == "http://a/1" and got["r"].summary == "본문 문단"
    assert str(got["r"].published) == "2026-07-16 01:00:00" == str(got["a"].published)
    filing = payloads.filing_events(payloads.feed_entries(df.filter("src = 'a'")).withColumn("form", F.lit("8-K"))).collect()[0]
    assert filing.accession == "0000320193-26-000001" and filing.key == "edgar_0000320193-26-000001"


def test_notices_are_left_out(spark):
    df = spark.createDataFrame([("정책 세미나 개최",), ("기준금리 인하 결정",)], "title string")
    assert [r.title for r in payloads.without_notices(df).collect()] == ["기준금리 인하 결정"]


def test_rate_event_documents(spark):
    rows = spark.createDataFrame([("DFF", "Fed", "2026-07-01", 3.25, 3.5, -25, 0.25)],
                                 "series_id string, entity string, d string, value double, prev_value double, delta_bp long, delta_points double")
    rows = rows.withColumn("ts", F.col("d").cast("timestamp"))
    fed, bok = G.rate_events(rows, False).collect()[0], G.rate_events(rows, True).collect()[0]
    assert fed.title == "미 연준 기준금리 변동 (3.25%)" and fed.key == "fred_DFF_2026-07-01"
    assert [(a.metric, a.value, a.unit) for a in fed.anchors] == [("기준금리", 3.25, "%"), ("변동폭", -25.0, "bp")]
    assert bok.title == "한국은행 기준금리 인하 (3.25%)" and (bok.anchors[1].value, bok.anchors[1].unit) == (0.25, "%p")


def test_dictionaries(spark, tmp_path):
    (tmp_path / "e.yaml").write_text("institutions:\n  - { key: BOK, aliases: [한국은행, 한은] }\n", encoding="utf-8")
    (tmp_path / "c.yaml").write_text("RATE:\n  keywords: [금리]\n  prototypes: [금리를 조정했다]\nETC:\n  label: x\n", encoding="utf-8")
    (tmp_path / "g.yaml").write_text('채권:\n  easy: "빌린 증서예요"\n  aliases: [bond]\n금리: "돈값이에요"\n', encoding="utf-8")
    (tmp_path / "p.yaml").write_text("pairs:\n  - { a: x, b: y, same: true }\n  - { a: x, b: z }\n", encoding="utf-8")
    aliases, groups = Y.load_entities(str(tmp_path / "e.yaml"))
    assert aliases == [("한국은행", "BOK"), ("한은", "BOK")] and groups == {"BOK": "institutions"}
    assert Y.alias_table(spark, aliases, groups).count() == 2
    assert Y.load_categories(str(tmp_path / "c.yaml"))[0] == [("RATE", ["금리"]), ("ETC", [])]
    surfaces, entries = Y.load_glossary(str(tmp_path / "g.yaml"))
    assert surfaces == {"채권": "채권", "bond": "채권", "금리": "금리"} and entries[1] == ("금리", "돈값이에요", "")
    assert [r.same for r in Y.load_pairs(spark, str(tmp_path / "p.yaml")).collect()] == [True, False]


def test_vectors_are_unit_and_close_for_inflected_words(spark):
    rows = spark.createDataFrame([("1", "기준금리를 인하했다", ""), ("2", "기준금리 인하", ""), ("3", "해운 운임 하락", "x")], "id string, title string, lead string")
    v = {r.id: np.array(r.vec) for r in E.text_vectors(rows, Settings()).collect()}
    assert all(abs(np.linalg.norm(x) - 1) < 1e-5 for x in v.values())
    assert v["1"] @ v["2"] > 0.6 > v["1"] @ v["3"]
    half = spark.createDataFrame([([0.1, 1 / 3],)], "v array<float>").select(half_precision("v").alias("h")).collect()[0].h
    assert half == [float(np.float16(0.1)), float(np.float16(np.float32(1 / 3)))]


def test_evaluation_finds_a_threshold(spark):
    pairs = spark.createDataFrame(
        [(1, "기준금리 인하 결정", "기준금리 인하 단행", True), (2, "기준금리 인하", "해운 운임 하락", False)], "pair long, a string, b string, same boolean")
    got = {r.tau: r.f1 for r in evaluate(pairs, Settings(), None, 0.4, 0.9, 0.1).collect()}
    assert max(got.values()) == 1.0 and len(got) == 6


def test_publishing_replaces_what_was_there(spark, tmp_path):
    rows = spark.createDataFrame([("a", "active", 5), ("b", "stale", 9)], "id string, status string, importance long").withColumn("last_update", ts("2026-07-10"))
    for cards in (rows, rows.filter("id = 'b'")):
        landing.publish(index_document(cards, ts("2026-07-10"), "src"), cards, str(tmp_path / "out"))
    index, details = landing.read_published(spark, str(tmp_path / "out"))
    assert [json.loads(c)["id"] for c in index.first().issues] == ["b"]
    assert [r.id for r in details.collect()] == ["b"]


def test_disclosures_and_filings_become_whole_events(spark):
    now = ts("2031-05-06")
    reports = spark.createDataFrame(
        [("r1", "c1", "Seadrill 산업", "분기보고서 (2031.03)", "20310510"), ("r2", "c2", "무명 회사", "분기보고서 (2031.03)", "20310510")],
        "receipt_no string, corp_code string, corp_name string, report_name string, receipt_day string")
    facts = spark.createDataFrame(
        [("c1", "2031", "11013", "CFS", "매출액", "12,300,000,000", 1), ("c1", "2031", "11013", "OFS", "매출액", "1", 2), ("c1", "2031", "11013", "CFS", "영업이익", "900,000,000", 3)],
        "corp_code string, year string, report_code string, division string, account string, amount string, seq int")
    one, = payloads.disclosure_documents(reports, facts, [("Seadrill", "SEA")], now, "https://receipts.test/").collect()
    assert one.key == "dart_r1" and one.category == "EARNINGS" and one.created_at is not None and one.headlines is None
    assert [(a.entity, a.metric, a.value, a.unit, a.prev, a.period, a.source) for a in one.anchors] == [
        ("Seadrill 산업", "매출액", 123.0, "억원", None, one.period, "DART"), ("Seadrill 산업", "영업이익", 9.0, "억원", None, one.period, "DART")]
    assert tuple(one.timeline) == ("official", "Seadrill 산업 분기보고서 (2031.03)", "DART", "https://receipts.test/r1")
    entries = spark.createDataFrame(
        [("10-Q", "Larkspur Corp (0000123456) (Filer)", "AccNo: 0000123456-31-000007 CIK=123456", "https://filings.test/0000123456-31-000007")],
        "form string, title string, summary string, link string")
    concepts = spark.createDataFrame([("123456", "Revenues", "10-Q", "CY2031Q1", "2031-03-31", 5.25e8, 1)],
                                     "cik string, tag string, form string, frame string, end string, val double, seq int")
    two, = payloads.filing_documents(entries, concepts, now).collect()
    assert two.period == "2031-2Q" and two.timeline.source == "EDGAR" and two.timeline.url == entries.first().link
    assert [(a.metric, a.value, a.unit, a.period, a.source) for a in two.anchors] == [("매출", 525.0, "백만달러", "2031-03-31", "EDGAR")]
    # both feed the jobs on events as they are
    from issueloom.operators import events as V
    from issueloom.plans.state import empty_state

    state = empty_state(spark)
    both = payloads.disclosure_documents(reports, facts, [("Seadrill", "SEA")], now, "u").unionByName(payloads.filing_documents(entries, concepts, now))
    linked = V.link_events(V.pending(both, state["processed"]), state["issues"])
    assert V.event_anchors(linked, now).count() == 3 and V.event_timeline(linked, now).count() == 2
