"""Explicit schemas of everything that is read; nothing is inferred."""

from __future__ import annotations

RAW_ARTICLE = (
    "id string, source string, tier string, url string, title string, lead string, published_at string, lang string, "
    "collected_at string"
)
EVENT = (
    "key string, created_at timestamp, category string, entity string, period string, title string, "
    "anchors array<struct<entity:string,metric:string,value:double,unit:string,prev:double,period:string,source:string,"
    "observed_at:timestamp>>, timeline struct<kind:string,title:string,source:string,url:string>, "
    "headlines array<struct<title:string,url:string,source:string,tier:string,lang:string,published_at:timestamp>>"
)
SEARCH_PAYLOAD = (
    "articles array<struct<url:string,title:string,domain:string,seendate:string,language:string>>"
)
OBSERVATION_PAYLOAD = "observations array<struct<date:string,value:string>>"
STATISTICS_PAYLOAD = "StatisticSearch struct<row:array<struct<TIME:string,DATA_VALUE:string>>>"
INDEX_PAYLOAD = (
    "response struct<body:struct<items:struct<item:array<struct<basDt:string,clpr:string>>>>>"
)
RSS_SCHEMA = (
    "channel struct<item:array<struct<title:string,link:string,description:string,pubDate:string,date:string>>>"
)
ATOM_SCHEMA = (
    "entry array<struct<title:string,link:array<struct<_rel:string,_href:string>>,summary:string,content:string,"
    "published:string,updated:string>>"
)
FACT = "corp_code string, year string, report_code string, division string, account string, amount string"
CONCEPT = "cik string, metric string, tag string, form string, frame string, end string, val double"
