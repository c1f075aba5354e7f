"""Reading of times: as the list of formats tried one after the other, each text once and only by formats that can fit."""

from pyspark.sql import functions as F

from issueloom.functions import text as X
from issueloom.sources import landing

GIVEN = [
    "Tue, 09 Jan 2024 12:04:05 +0900", "Tue 9 jan 2024 03:04 GMT", "9 Jan 2024 03:04:05", "Tuesday, 09 Jan 2024 03:04:05 PST", "009 Jan 2024 03:04:05",
    "-9 Jan 2024 03:04:05", "9  Jan 2024 03:04:05", "9\tJan 2024 03:04:05", "Jan 9 2024", "32 Jan 2024 03:04:05", "2024-01-09T03:04:05Z", "2024-01-09 03:04",
    "2024", "2024-01-09T03:04:05.123456+00:00", "soon", "", None, " 9 Jan 2024 03:04:05 EST ", "12:30", "9 Sept 2024 03:04:05", "9 Jan 24 03:04:05",
]


def every_format(text):
    s = F.trim(X.or_empty(text))
    mail = F.regexp_replace(s, r"^[A-Za-z]{3,9},?\s+", "")
    for name, offset in X.ZONES.items():
        mail = F.regexp_replace(mail, rf"\s{name}$", f" {offset}")
    tried = [F.try_to_timestamp(mail, F.lit(f"d MMM yyyy HH:mm{rest}")) for rest in (":ss Z", " Z", ":ss")]
    return F.coalesce(*tried, F.try_to_timestamp(s))


def test_the_formats_left_out_could_not_have_fitted(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(GIVEN)], "i int, t string").where("i >= 0")
    got = rows.select("i", X.parse_time("t").cast("string").alias("got"), every_format("t").cast("string").alias("want")).orderBy("i").collect()
    assert [r.got for r in got if GIVEN[r.i] != "12:30"] == [r.want for r in got if GIVEN[r.i] != "12:30"]
    assert sum(r.want is not None for r in got) > 8


def test_the_lookback_reads_a_time_once(spark):
    given = ["soon", "2024-01-30T00:00:00Z", "2024-01-31T00:00:00Z", "Tue, 30 Jan 2024 23:00:00 GMT", None]
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, collected_at string").where("i >= 0")
    rows = landing.recent(raw, F.lit("2024-01-31 12:00:00").cast("timestamp"), 24).select("i")
    assert sorted(r.i for r in rows.collect()) == [0, 2, 3, 4]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("d MMM yyyy HH:mm:ss Z") == 1
