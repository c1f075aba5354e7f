"""Payload tables (one fetched document per row) to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import entity_keys, is_foreign, or_empty, parse_time, period_bucket, strip_tags
from ..operators.ordered import spread_join, top_n
from ..settings import (
    EARNINGS_PATTERN, NOTICE_PATTERN, OPERATING_INCOME_TAGS, REPORT_QUARTER, RESULTS_ITEM_PATTERN, REVENUE_TAGS,
)
from .schemas import ATOM_SCHEMA, EVENT, INDEX_PAYLOAD, OBSERVATION_PAYLOAD, RSS_SCHEMA, SEARCH_PAYLOAD, STATISTICS_PAYLOAD


def feed_entries(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """RSS items and Atom entries as (…, title, link, summary, published); noise before the root is cut off."""
    body = F.regexp_extract(or_empty(text), r"(?s)(<(?:rss|feed)[\s>].*)", 1)
    options = {"ignoreNamespace": "true", "attributePrefix": "_"}
    rows = payloads.withColumn("_body", body).drop(text)
    keep = [c for c in rows.columns if c != "_body"]
    rss = rows.filter(F.col("_body").startswith("<rss")).withColumn("_x", F.from_xml("_body", RSS_SCHEMA, options))
    rss = rss.select(*keep, F.posexplode("_x.channel.item").alias("pos", "e")).select(
        *keep, "pos", strip_tags("e.title").alias("title"), F.trim(or_empty("e.link")).alias("link"),
        strip_tags("e.description").alias("summary"), parse_time(F.coalesce("e.pubDate", "e.date")).alias("published"),
    )
    atom = rows.filter(F.col("_body").startswith("<feed")).withColumn("_x", F.from_xml("_body", ATOM_SCHEMA, options))
    atom = atom.select(*keep, F.posexplode("_x.entry").alias("pos", "e"))
    main = F.get(F.filter("e.link", lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate")), F.lit(0))["_href"]
    first_text = lambda a, b: F.when(or_empty(a) != "", F.col(a)).otherwise(F.col(b))
    atom = atom.select(
        *keep, "pos", strip_tags("e.title").alias("title"), F.trim(or_empty(main)).alias("link"),
        strip_tags(first_text("e.summary", "e.content")).alias("summary"),
        parse_time(F.coalesce("e.published", "e.updated")).alias("published"),
    )
    return rss.unionByName(atom).filter((F.col("title") != "") & (F.col("link") != ""))


def without_notices(entries: DataFrame, pattern: str = NOTICE_PATTERN) -> DataFrame:
    return entries.filter(~F.col("title").rlike(pattern))


def search_articles(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Article search results as article rows."""
    keep = [c for c in payloads.columns if c != text]
    rows = payloads.select(*keep, F.posexplode(F.from_json(text, SEARCH_PAYLOAD)["articles"]).alias("pos", "a"))
    seen = F.when(F.col("a.seendate").rlike(r"^\d{8}T\d{6}Z$"), F.try_to_timestamp("a.seendate", F.lit("yyyyMMdd'T'HHmmss'Z'")))
    korean = F.lower(or_empty("a.language")).isin("korean", "ko")
    return rows.filter((or_empty("a.url") != "") & (or_empty("a.title") != "")).select(
        *keep, "pos", F.col("a.url").alias("url"), F.col("a.title").alias("title"), F.lit("").alias("lead"),
        F.when(or_empty("a.domain") != "", F.col("a.domain")).otherwise("gdelt").alias("source"),
        seen.alias("published_at"), F.when(korean, "ko").otherwise("en").alias("lang"),
    )


def observations(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """(series_id, ts, value) from observation payloads; missing points are marked with a dot or left empty."""
    rows = payloads.select("series_id", F.explode(F.from_json(text, OBSERVATION_PAYLOAD)["observations"]).alias("o"))
    value = F.col("o.value").try_cast("double")
    return rows.filter(value.isNotNull()).select("series_id", F.col("o.date").cast("date").alias("ts"), value.alias("value"))


def statistics(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """(series_id, time, value) from statistics payloads; rows without a number are dropped."""
    rows = payloads.select("series_id", F.explode(F.from_json(text, STATISTICS_PAYLOAD)["StatisticSearch"]["row"]).alias("r"))
    value = F.col("r.DATA_VALUE").try_cast("double")
    return rows.filter(value.isNotNull() & F.col("r.TIME").isNotNull()).select(
        "series_id", F.col("r.TIME").alias("time"), value.alias("value")
    )


def index_closes(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """(series_id, t, value) of daily closes."""
    rows = payloads.select("series_id", F.explode(F.from_json(text, INDEX_PAYLOAD)["response"]["body"]["items"]["item"]).alias("i"))
    value = F.col("i.clpr").try_cast("double")
    return rows.filter(value.isNotNull()).select(
        "series_id", F.to_date(F.try_to_timestamp("i.basDt", F.lit("yyyyMMdd"))).alias("t"), value.alias("value")
    )


def earnings_events(disclosures: DataFrame, facts: DataFrame, aliases: list[tuple[str, str]], per_event: int = 4) -> DataFrame:
    """Earnings disclosures of listed companies as events with up to 4 anchors.

    Facts are joined on the event's own quarter, consolidated revenue and operating profit only, in 1e8 units.
    """
    return _earnings(disclosures, facts, aliases, per_event).select("key", "category", "entity", "period", "title", "anchors")


def _earnings(disclosures: DataFrame, facts: DataFrame, aliases: list[tuple[str, str]], per_event: int) -> DataFrame:
    kept = disclosures.filter(F.col("report_name").rlike(EARNINGS_PATTERN) & (F.size(entity_keys("corp_name", aliases)) > 0))
    kept = kept.withColumn("period", period_bucket("report_name", "receipt_day"))
    quarter = F.create_map(*[F.lit(x) for kv in REPORT_QUARTER.items() for x in kv])
    amount = F.replace(F.col("amount"), F.lit(","), F.lit("")).try_cast("double")
    usable = facts.filter((F.col("division") == "CFS") & F.col("account").isin("매출액", "영업이익") & amount.isNotNull())
    usable = usable.select(
        "corp_code", F.concat_ws("-", "year", F.element_at(quarter, F.col("report_code"))).alias("period"), "seq",
        F.struct(F.col("account").alias("metric"), F.round(amount / 1e8, 1).alias("value")).alias("anchor"),
    )
    first = top_n(usable, ["corp_code", "period"], [F.col("seq")], per_event)
    packed = first.groupBy("corp_code", "period").agg(F.array_sort(F.collect_list(F.struct("seq", "anchor"))).alias("_a"))
    early = F.when(F.col("report_name").contains("잠정"), "잠정").otherwise("")
    return spread_join(kept, packed, ["corp_code", "period"], "left", ["receipt_no"]).select(
        F.concat(F.lit("dart_"), "receipt_no").alias("key"), F.lit("EARNINGS").alias("category"),
        F.col("corp_name").alias("entity"), "period",
        F.concat("corp_name", F.lit(" "), "period", F.lit(" "), early, F.lit("실적 공시")).alias("title"),
        F.coalesce(F.transform("_a", lambda x: x["anchor"]), F.array().cast("array<struct<metric:string,value:double>>")).alias("anchors"),
        "report_name", "receipt_no",
    )


def _documents(rows: DataFrame, now: Column, source: str, anchors: Column, told: Column, url: Column) -> DataFrame:
    """Rows (key, entity, period, title) as whole event documents, in the columns that the jobs on events read."""
    completed = F.transform(anchors, lambda a: F.struct(
        F.col("entity").alias("entity"), a["metric"].alias("metric"), a["value"].alias("value"), a["unit"].alias("unit"),
        F.lit(None).cast("double").alias("prev"), a["period"].alias("period"), F.lit(source).alias("source"),
        F.lit(None).cast("timestamp").alias("observed_at")))
    document = rows.select(
        "key", now.alias("created_at"), F.lit("EARNINGS").alias("category"), "entity", "period", "title", completed.alias("anchors"),
        F.struct(F.lit("official").alias("kind"), told.alias("title"), F.lit(source).alias("source"), url.alias("url")).alias("timeline"),
        F.lit(None).alias("headlines"))
    fields = rows.sparkSession.createDataFrame([], EVENT).schema.fields
    return document.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def disclosure_documents(disclosures: DataFrame, facts: DataFrame, aliases: list[tuple[str, str]], now: Column, url: str, per_event: int = 4) -> DataFrame:
    """Earnings disclosures as whole event documents; `url` is the address of a receipt up to its number."""
    rows = _earnings(disclosures, facts, aliases, per_event)
    anchors = F.transform("anchors", lambda a: F.struct(
        a["metric"].alias("metric"), a["value"].alias("value"), F.lit("억원").alias("unit"), F.col("period").alias("period")))
    return _documents(rows, now, "DART", anchors, F.concat_ws(" ", "entity", "report_name"), F.concat(F.lit(url), "receipt_no"))


def filing_documents(entries: DataFrame, concepts: DataFrame, now: Column, n: int = 4) -> DataFrame:
    """Filing entries as whole event documents of the quarter they are read in."""
    quarter = F.concat(F.year(now).cast("string"), F.lit("-"), F.quarter(now).cast("string"), F.lit("Q"))
    rows = filing_anchors(filing_events(entries), concepts, n).withColumn("period", quarter)
    return _documents(rows, now, "EDGAR", F.col("anchors"), F.concat_ws(" ", "entity", "form"), F.col("link"))


def filing_events(entries: DataFrame) -> DataFrame:
    """Filing entries (form, title, summary, link) as events keyed by accession number.

    An 8-K counts only when it reports results. Entries without an accession number are dropped.
    """
    results = F.concat_ws(" ", "title", "summary").rlike(f"(?i){RESULTS_ITEM_PATTERN}")
    kept = entries.filter((F.col("form") != "8-K") | results)
    blob = F.concat_ws(" ", or_empty("link"), or_empty("summary"), or_empty("title"))
    named = F.regexp_extract(blob, r"(?i)accession[-_ ]?(?:number|no)?[=:\s]*([\d-]{18,20})", 1)
    in_path = F.regexp_extract(blob, r"/(\d{10}-\d{2}-\d{6})", 1)
    accession = F.when(named != "", named).when(in_path != "", in_path)
    cik = F.regexp_extract(blob, r"(?i)CIK=(\d+)", 1)
    company = F.trim(or_empty("title"))
    for form in ("8-K", "10-Q", "10-K"):
        company = F.when(F.col("form") == form, F.regexp_replace(company, rf"\s*\({form}\)\s*$", "")).otherwise(company)
    company = F.trim(F.regexp_replace(company, r"\s*\(\d{7,10}\)\s*(\(.*\))?$", ""))
    return kept.withColumn("accession", accession).filter(F.col("accession").isNotNull()).select(
        F.concat(F.lit("edgar_"), "accession").alias("key"), "accession",
        F.when(company == "", "Unknown").otherwise(company).alias("entity"),
        F.when(cik != "", cik).alias("cik"), "form", "link",
        F.concat(F.when(company == "", "Unknown").otherwise(company), F.lit(" "), "form", F.lit(" 공시")).alias("title"),
    )


def latest_quarters(concepts: DataFrame, tags: list[str], n: int = 4) -> DataFrame:
    """Latest n quarters per (cik, metric) from the first tag that has data, framed rows preferred, in 1e6 units.

    `tags` gives the preference. The first tag per key is an aggregate, not a window over all facts.
    """
    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    usable = concepts.filter(F.col("form").isin("10-Q", "10-K") & (rank > 0) & F.col("val").isNotNull()).withColumn(
        "_choice", F.struct(rank.alias("tag_rank"), F.col("frame").isNull().cast("int").alias("unframed"))
    )
    chosen = usable.groupBy("cik", "metric").agg(F.min("_choice").alias("_best"))
    same = spread_join(usable, chosen, ["cik", "metric"], "inner", ["seq"]).filter(F.col("_choice") == F.col("_best"))
    newest = top_n(same, ["cik", "metric"], [F.col("end").desc(), F.col("seq")], n)
    return newest.select("cik", "metric", "end", F.round(F.col("val") / 1e6, 1).alias("value"), F.col("rn").alias("rank"))


def filing_anchors(events: DataFrame, concepts: DataFrame, n: int = 4) -> DataFrame:
    """Filings with up to n anchors: revenue of the latest quarters first, then operating income."""
    parts = []
    for order, (metric, tags) in enumerate((("매출", REVENUE_TAGS), ("영업이익", OPERATING_INCOME_TAGS))):
        rows = latest_quarters(concepts.withColumn("metric", F.lit(metric)), tags, n)
        parts.append(rows.withColumn("_o", F.lit(order)))
    both = top_n(parts[0].unionByName(parts[1]), ["cik"], [F.col("_o"), F.col("rank")], n, "_r")
    anchor = F.struct("_r", "metric", "value", F.col("end").alias("period"))
    packed = both.groupBy("cik").agg(F.array_sort(F.collect_list(anchor)).alias("_a"))
    out = spread_join(events, packed, ["cik"], "left", ["key"])
    shown = F.transform("_a", lambda a: F.struct(
        a["metric"].alias("metric"), a["value"].alias("value"), F.lit("백만달러").alias("unit"), a["period"].alias("period")))
    none = F.array().cast("array<struct<metric:string,value:double,unit:string,period:string>>")
    return out.withColumn("anchors", F.coalesce(shown, none)).drop("_a")
