"""Cycles over generated news: what each rule keeps, what a cycle writes, and what a later one leaves alone."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from issueloom.functions.text import url_id
from issueloom.plans.cycle import Dictionaries, run_cycle
from issueloom.plans.state import Snapshot, load_state, save_state, vacuum, versions
from issueloom.settings import Settings
from issueloom.sources import landing
from issueloom.streaming import jobs as J

START = dt.datetime(2031, 3, 3, 9, 30, 0)
# Words of invented topics; a headline takes most words of its topic in some order and one of its own.
TOPICS = {
    "dam": "Wendale reservoir drought ration farms irrigation council meeting".split(),
    "comet": "Ostrava observatory comet telescope brightness tail astronomers night".split(),
    "ferry": "Lindholm ferry engine refit harbour passengers timetable strike".split(),
    "moss": "peat moss seedlings botanists hillside experiment roots moisture".split(),
}
ALIASES = [("Wendale", "WENDALE"), ("Lindholm", "LINDHOLM"), ("Ostrava", "OSTRAVA")]
RULES = Settings(tau_join=0.45, tau_hold=0.3, merge_sim=0.8)
DICTIONARIES = Dictionaries(aliases=ALIASES, groups={"WENDALE": "institutions"},
                            categories=[("POLICY", ["ration"]), ("GEO", ["comet"]), ("ETC", [])])


def iso(t):
    return t.isoformat() + "+00:00"


def story(topic, number, source, at, title=None, like=None):
    """One landed line; the words of another number's where it is named."""
    rng = random.Random(f"{topic}{number if like is None else like}")
    words = rng.sample(TOPICS[topic], 7) + [f"edition{topic}{number}"]
    own = " ".join("".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(4))
    url = f"https://{source}.test/{topic}/{number}"
    return {"id": url, "source": source, "tier": "wire", "url": url, "title": title or " ".join(words), "lead": own,
            "published_at": iso(at - dt.timedelta(minutes=7 * number)), "lang": "en", "collected_at": iso(at)}


def first_day():
    """Four sources and a near copy on the dam, two sources on the comet, one source twice on the ferry, one line on moss."""
    rows = [story("dam", i, f"paper{i}", START) for i in range(4)] + [story("comet", i, f"sky{i}", START) for i in range(2)]
    rows.append(story("dam", 9, "copier", START, rows[0]["title"] + "!", like=0))
    rows += [story("ferry", i, "dock", START) for i in range(2)] + [story("moss", 0, "green", START)]
    rows.append(dict(rows[2]))  # the same article twice
    rows.append({**story("moss", 5, "green", START), "title": "  "})
    rows.append({**story("moss", 6, "green", START), "collected_at": iso(START - dt.timedelta(hours=RULES.lookback_h + 9))})
    return rows


def fact(entity, metric, value, unit, prev, period, source, at):
    return {"entity": entity, "metric": metric, "value": value, "unit": unit, "prev": prev, "period": period, "source": source, "observed_at": iso(at)}


def documents():
    """An official event that the dam's headlines belong to, and one that happened days before it was written."""
    ago = START - dt.timedelta(days=6)
    water = {"key": "wendale_ration", "created_at": iso(START), "category": "POLICY", "entity": "Wendale", "period": "2031-03",
             "title": "Wendale reservoir drought ration council meeting", "timeline": {"kind": "official", "title": "Ration notice", "source": "notice", "url": "https://notice.test/w"},
             "anchors": [fact("Wendale", "ration", 31.0, "%", 36.0, "2031-03", "notice", START)]}
    toll = {"key": "toll_crown", "created_at": iso(ago), "category": "FX", "entity": "Toll crown", "period": "2031-02",
            "title": "Toll crown leaves its band", "timeline": {"kind": "headline", "title": "Crown leaves band", "source": "dock", "url": "https://dock.test/c"},
            "anchors": [fact("Toll crown", "crown per mark", 7.25, "", None, "2031-02", "exchange", ago)]}
    return [water, toll]


def land(spark, folder, rows, now):
    month = folder / "raw" / "month=2031-03"
    month.mkdir(parents=True, exist_ok=True)
    (month / "lines.jsonl").write_text("\n".join([*map(json.dumps, rows), '{"id": "cut off']), encoding="utf-8")
    clock = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    return landing.read_raw(spark, str(folder / "raw"), clock, ("2031-03",), RULES).withColumn("id", url_id("url")), clock


def told(payload):
    """Generated summaries that obey all rules."""
    text = json.dumps({
        "title": "소식을 모았어요", "one_liner": "오늘 소식을 모았어요", "why_now": "오늘 알려졌어요", "impact_line": "살림에 닿을 수 있어요",
        "details": ["먼저 결정을 전해요", "다음은 배경을 전해요", "끝으로 앞일을 전해요"], "visual_type": "none", "effects": ["장보기가 달라질 수 있어요!"], "glossary": []},
        ensure_ascii=False)
    return payload.select("issue_id", F.lit(text).alias("text"))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Three cycles: the first day; the same lines and some new ones nine days on; forty days later without news."""
    folder = tmp_path_factory.mktemp("world")
    events_at = folder / "events"
    events_at.mkdir()
    for e in documents():
        (events_at / f"{e['key']}.json").write_text(json.dumps(e), encoding="utf-8")
    (events_at / "torn.json").write_text('{"key": ', encoding="utf-8")
    events = landing.read_events(spark, str(events_at))
    root, out = str(folder / "state"), []
    state = Snapshot(spark, root)
    later = START + dt.timedelta(days=9)
    days = [(START, first_day()), (later, first_day() + [story("comet", 20 + i, f"sky{i}", later) for i in range(2)]), (START + dt.timedelta(days=49), [])]
    for version, (now, rows) in enumerate(days):
        raw, clock = land(spark, folder / str(version), rows, now)
        state, stats, cards, details = run_cycle(spark, state, raw, events, clock, DICTIONARIES, RULES, generate=told, folder=root)
        out.append({"state": state, "stats": stats, "cards": {c.id: c for c in cards.collect()}, "details": details.collect(),
                    "issues": {r.id: r for r in state["issues"].collect()}, "articles": {r.url: r for r in state["articles"].collect()}})
    return root, events, out


def by_key(cycle, key):
    return [i for i in cycle["issues"].values() if key in i["keys"]]


def test_first_cycle_follows_the_rules(world):
    _, _, (first, _, _) = world
    stats = first["stats"]
    assert (stats["inserted"], stats["near_dups"], stats["express"]) == (10, 1, 2)
    assert {u for u, a in first["articles"].items() if a.is_dup} == {"https://copier.test/dam/9"}
    dam, = by_key(first, "WENDALE")
    assert dam.origin == "official_event" and dam.status == "active" and dam.seen_sources >= 4 and dam.vec is not None
    comet, = by_key(first, "OSTRAVA")
    assert (comet.origin, comet.status, comet.category, comet.seen_sources) == ("cluster", "active", "GEO", 2)
    ferry, = by_key(first, "LINDHOLM")  # one source only: no publication
    assert ferry.status == "candidate" and ferry.id not in first["cards"]
    assert first["articles"]["https://green.test/moss/0"].issue_id is None
    shown = first["cards"]
    assert dam.id in shown and comet.id in shown and shown[dam.id].headline_stat.value == "31"
    late, = [c for c in shown.values() if c.category == "FX"]
    assert late.event_at < late.last_update
    assert all(d.timeline and d.details and d.model == "generated" for d in first["details"])
    assert {n for a in first["articles"].values() for n in a.num_tags or []} >= set()


def test_second_cycle_takes_only_what_is_new(world):
    _, _, (first, second, _) = world
    assert second["stats"]["inserted"] == 2 and second["stats"]["express"] == 0
    assert len(second["articles"]) == len(first["articles"]) + 2
    same = [u for u in first["articles"] if first["articles"][u].asDict() == second["articles"][u].asDict()]
    assert len(same) == len(first["articles"])  # old rows are as they were


def test_a_cycle_writes_only_parts_that_changed(world):
    root, _, cycles = world
    parts = [c["state"].parts for c in cycles]
    assert all(g == 0 for t in parts[0].values() for g in t.values())
    old = parts[0]["articles"]
    assert {p: g for p, g in parts[1]["articles"].items() if p in old} == old  # no file of the first day is written again
    new = {p for p, g in parts[1]["articles"].items() if g == 1}
    assert len(new) == 1 and not new & set(old)
    assert {t for t, ps in parts[1].items() for g in ps.values() if g == 0} >= {"articles", "anchors", "processed"}
    # the third archives everything: days of their members lose the vectors, and only these are written
    third = cycles[2]
    assert {i.status for i in third["issues"].values()} == {"archived"}
    assert all(a.vec is None for a in third["articles"].values() if a.issue_id is not None)
    assert third["articles"]["https://green.test/moss/0"].vec is not None
    assert parts[2]["timeline"] == parts[1]["timeline"] and parts[2]["anchors"] == parts[1]["anchors"]


def test_a_failed_cycle_leaves_the_version_before(spark, world):
    root, events, cycles = world
    before = load_state(spark, root)
    assert before.version == 2 and versions(spark, root) == [0, 1, 2]

    def broken(payload):
        raise RuntimeError("no answer")

    raw, clock = land(spark, __import__("pathlib").Path(root).parent / "broken", [story("comet", 90 + i, f"sky{i}", START) for i in range(2)], START)
    with pytest.raises(RuntimeError):
        run_cycle(spark, before, raw, events, clock, DICTIONARIES, RULES, generate=broken, folder=root)
    again = load_state(spark, root)
    assert again.version == 2 and again["articles"].count() == len(cycles[2]["articles"])


def test_vacuum_keeps_what_versions_name(spark, world, tmp_path):
    root, _, cycles = world
    copy = str(tmp_path / "copy")
    state = save_state(load_state(spark, root), load_state(spark, root), copy, 0)
    one = {**state, "reviews": state["reviews"].unionByName(spark.createDataFrame([("x", "y", None)], "issue_id string, reason string, at timestamp"))}
    two = save_state(state, one)
    three = save_state(two, {**two, "reviews": state["reviews"]})
    assert three.version == 2 and two["reviews"].count() == three["reviews"].count() + 1
    assert vacuum(spark, copy, keep=1) >= 1 and versions(spark, copy) == [2]
    left = load_state(spark, copy)
    for name in left:
        assert sorted(map(str, left[name].collect())) == sorted(map(str, load_state(spark, root)[name].collect()))


def test_batches_publish_and_repeat(spark, world, tmp_path):
    root, events, cycles = world
    state = load_state(spark, root, 0)
    path = str(tmp_path / "stream")
    save_state(state, state, f"{path}/state", 0)
    raw, clock = land(spark, tmp_path, first_day(), START)
    save = J.cycle_batches(path, lambda b: events, lambda b: clock, DICTIONARIES, RULES, generate=told)
    for _ in range(2):  # a batch that is delivered twice commits one version
        save(raw, 1)
        assert save.stats["inserted"] == 0 and save.stats["express"] == 0 and save.stats.get("process", 0) == 0
        assert save.stats["cached"] >= 3 and versions(spark, f"{path}/state") == [0, 1]
        assert load_state(spark, f"{path}/state")["runs"].count() == 2
    index, details = landing.read_published(spark, f"{path}/published")
    shown = cycles[0]["cards"]
    row, = index.collect()
    assert row.schema_version == 3 and len(row.issues) == len(shown) and {d.id for d in details.select("id").collect()} == set(shown)


def test_publication_is_swapped_in_one_step(spark, tmp_path):
    folder = str(tmp_path / "p")
    index = lambda n: spark.createDataFrame([(n,)], "n int")
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    landing.publish(index(1), rows("a", "b"), folder)
    boom = F.udf(lambda x: 1 // 0, "string")
    with pytest.raises(Exception):
        landing.publish(index(2), rows("c").select(boom("id").alias("id")), folder)
    one, docs = landing.read_published(spark, folder)
    assert one.first().n == 1 and {r.id for r in docs.collect()} == {"a", "b"}  # the killed one is never seen
    landing.publish(index(3), rows("b"), folder)
    one, docs = landing.read_published(spark, folder)
    assert one.first().n == 3 and {r.id for r in docs.collect()} == {"b"}  # what is no longer live is gone
