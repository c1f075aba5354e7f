"""Operators of the llm subpackage against plain versions, with nulls, empty texts, ties, repeated rows and extra columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

from issueloom.llm import catalog, decontam, langid, mixing, mtree, pii, shards, simhash, tokenfile, toxicity, warc
from issueloom.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, score double, node string"
ROWS = [(1, "the quick brown fox jumps over the lazy dog", "en", "b", 0.5, "x"), (1, "the quick brown fox jumps over the lazy dog", "en", "b", 0.5, "x"),
        (2, None, None, None, None, None), (3, "", "en", "a", 1.0, "y"), (None, "der schnelle braune fuchs springt", "de", "a", None, None),
        (4, "... 123 !!", "en", "b", 0.0, ""), (5, "wort " * 30_000, "de", "a", 0.1, "z"), (20, "the quick brown fox jumps over the lazy dog", None, "a", 0.2, "w")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts(spark):
    return [(r["doc_id"], r["text"] or "") for r in catalog.table(spark, SF, "documents").collect()]


def test_language(spark, docs, none):
    rows = catalog.op1_language(spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in catalog.table(spark, SF, "documents").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    assert len(rows) == len(lang) and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.9
    said = langid.predict(docs, langid.fit(docs)).collect()
    assert sorted(r["lang_pred"] for r in said if not r["text"] or r["text"].startswith("...")) == ["und"] * 3
    empty = langid.fit(none)
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(none, langid.fit(docs)).count() == 0


def test_shards(spark, docs, none):
    for n in (1, 2, 17, 1000, 4097):
        shard, slot = shards.place(np.arange(n), n, 16, 3)
        assert sorted(zip(shard, slot)) == sorted({(p % 16, p // 16) for p in range(n)})
        assert (shards.row_at(shard, slot, n, 16, 3) == np.arange(n)).all()
    rows = catalog.op2_shards(spark, SF).collect()
    sizes = np.bincount([r["shard"] for r in rows], minlength=16)
    assert sizes.max() - sizes.min() <= 1 and all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s])) for s in range(16))
    text = dict(texts(spark))
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in catalog.op2_shards(spark, SF).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert shards.assign(docs, ["doc_id"]).count() == len(ROWS) and shards.assign(none, ["doc_id"]).count() == 0


def plain_fingerprint(text: str) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(len(w) - 2, 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == plain_components(e for e in edges if e[0] is not None and e[0] != e[1])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_golay_keys_meet():
    tables, rng = simhash.golay_tables(), np.random.default_rng(2)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(2):
        y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
    (a, m), (b, n) = simhash.golay_keys(x, tables), simhash.golay_keys(y, tables)
    assert all(set(p[i]) & set(q[j]) for p, i, q, j in zip(a, m, b, n))


def test_simhash(spark, docs, none):
    fp = {k: plain_fingerprint(t) for k, t in texts(spark)}
    links = [(a, b) for a in fp for b in fp if a <= b and (fp[a] ^ fp[b]).bit_count() <= 2]
    want = plain_components(links)
    rows = catalog.op3_simhash(spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {k: (f"{fp[k]:016x}", want[k]) for k in fp}
    got = simhash.classes(docs).collect()
    assert len(got) == len(ROWS) and {r["component"] for r in got if r["key"] in (2, 3)} == {2}
    assert simhash.classes(none).count() == 0


def test_near_copies(spark, docs, none):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    rows, pairs = [], []
    for i in range(60):
        w = list(rng.choice(words, 120))
        v = list(w)
        v[int(rng.integers(20, 100))] = "changed"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        pairs.append((2 * i, 2 * i + 1))
    df = spark.createDataFrame(rows + [(500, rows[0][1]), (500, rows[0][1])], "doc_id long, text string")
    root = {r["key"]: r["root"] for r in simhash.near_groups(df).collect()}
    assert np.mean([root[a] == root[b] for a, b in pairs]) >= 0.95 and len({root[2 * i] for i in range(60)}) == 60
    assert simhash.dedup(df).count() == len(set(root.values()))
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "5", "None"]
    assert simhash.dedup(none).count() == 0


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_roots(spark, rows):
    """Groups of the rows found, and by comparing all pairs."""
    sets = {k: set(zip(*(t.split()[i:] for i in range(5)))) for k, t in rows}
    want = plain_components([(a, b) for a in sets for b in sets if a <= b and jaccard(sets[a], sets[b]) >= 0.8])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = {r["key"]: r["root"] for r in simhash.near_groups(df).collect()}
    groups = lambda of: sorted(sorted(k for k in of if of[k] == x) for x in set(of.values()))
    return groups(root), groups(want)


def test_near_copies_of_one_base(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for size in (10, 30, 200):
        base = [f"b{size}x{i}" for i in rng.integers(0, 5000, 200)]
        for v in range(size + 1):
            w = list(base)
            for at in rng.choice(np.arange(5, 190, 12), 3, replace=False) if v else ():
                w[at] = f"v{size}x{v}x{at}"
            rows.append((n, " ".join(w)))
            n += 1
    got, want = near_roots(spark, rows)
    assert len(want) == 3 and got == want


def test_near_copies_in_mixed_buckets(spark):
    rng = np.random.default_rng(6)
    words, rows = [f"c{i}" for i in range(100)], []
    for g in range(60):  # the same words in another order, each with a text one word shorter and one two words shorter
        w = list(rng.permutation(words))
        rows += [(3 * g + v, " ".join(w[v:])) for v in range(3)]
    got, want = near_roots(spark, rows)
    assert len(want) == 60 and got == want


def test_near_copies_with_passages_more_or_less(spark):
    rng = np.random.default_rng(7)
    rows, n = [], 0
    for size in (60, 100, 400):
        for kind in range(3):
            for i in range(30):
                w = [f"w{x}" for x in rng.integers(0, 20_000, size)]
                some = [f"w{x}" for x in rng.integers(0, 20_000, int(0.22 * (size - 4)))]
                v = (w + some, some + w, w[:int(0.83 * (size - 4)) + 4])[kind]
                rows += [(n, " ".join(w)), (n + 1, " ".join(v))]
                n += 2
    got, want = near_roots(spark, rows)
    assert len(want) == n // 2 and got == want


def test_simple8b():
    rng = np.random.default_rng(4)
    for top in (2, 9, 300, 50_257, 2**33, 2**64 - 1):
        lengths = rng.integers(0, 90, 40)
        ids = rng.integers(0, top, int(lengths.sum()), dtype=np.uint64)
        words, taken = tokenfile.pack(ids, lengths)
        ends, at = np.cumsum(taken), np.cumsum(lengths)
        assert all((tokenfile.unpack(words[b - a:b]) == ids[d - c:d]).all() for a, b, c, d in zip(taken, ends, lengths, at))


def test_token_file(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    path = catalog.tokenizer_path()
    coder = Tokenizer.from_file(path)
    at, want = 0, {}
    for k, t in sorted(texts(spark)):
        ids = coder.encode(t, add_special_tokens=False).ids + [2]
        want[k] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in catalog.op4_tokens(spark, SF).collect()} == want
    odd = ["a  b", " lead", "trail ", "tab\there", "don't stop.\nNext, line", "x\n\ny", "日本語 text", "<|endoftext|> mid <|endoftext|>", "it's 3.14!", "ﬁ ɐ×÷ café…"]
    own = tokenfile.Encoder(open(path, encoding="utf-8").read())
    assert [np.frombuffer(own.encode(t), "<u4").tolist() for t in odd] == [coder.encode(t, add_special_tokens=False).ids for t in odd]
    tokenfile.write(docs, str(tmp_path / "f"), open(path, encoding="utf-8").read())
    back = tokenfile.read(spark, str(tmp_path / "f")).collect()
    assert sorted((str(r["key"]), r["ids"]) for r in back) == sorted((str(r[0]), coder.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in ROWS)
    assert tokenfile.round_trip(none, path).count() == 0


def test_mixing(spark, docs, none):
    rows = catalog.op5_mixing(spark, SF).collect()
    by = {}
    source = {r["doc_id"]: r["source"] for r in catalog.table(spark, SF, "documents").collect()}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
        by.setdefault(source[r["doc_id"]], []).append(r)
    assert all(abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 1 for v in by.values())
    assert abs(sum(v[0]["target"] for v in by.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-3
    mixed = mixing.mix(docs, [5, 2, 1])
    assert mixed.columns == docs.columns and mixing.mix(none, [5, 2, 1]).count() == 0 and mixing.plan(none, [5, 2, 1]).count() == 0


def plain_distance(item: list, text: list) -> int:
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (v != w)))
        row = new
    return min(row)


def test_decontamination(spark, docs, none):
    split = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", t.lower())
    items = {r["item_id"]: split(r["text"]) for r in catalog.table(spark, SF, "benchmark").collect()}
    small = {k: split(t) for k, t in texts(spark) if len(t) < 1500}
    want = {(k, i) for k, w in small.items() for i, item in items.items() if len(set(item) & set(w)) >= 0.5 * len(set(item)) and plain_distance(item, w) <= len(item) // 5}
    got = {(r["doc_id"], r["item_id"]) for r in catalog.op6_decontamination(spark, SF).collect() if r["doc_id"] in small}
    assert got == want and want
    base = next(iter(items.values()))
    bench = spark.createDataFrame([(1, " ".join(base)), (2, None), (3, ""), (1, " ".join(base))], "item_id long, text string")
    rng, rows = np.random.default_rng(6), []
    for n in range(40):
        w = list(base)
        for _ in range(len(base) // 5):
            w[int(rng.integers(len(w)))] = "other"
        rows.append((n, "x y z " * 5 + " ".join(w) + " end", "extra"))
    df = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    assert decontam.clean(df, bench).count() <= 2 and decontam.clean(df, bench).columns == df.columns
    assert decontam.clean(docs, bench).count() == len(ROWS) and decontam.clean(none, bench).count() == 0
    assert decontam.clean(df, bench.limit(0)).count() == 40


def test_decontamination_of_short_items_and_other_scripts(spark):
    items = [(1, "What is 2 + 2?"), (2, "\u6c34\u306e\u5316\u5b66\u5f0f\u306f\u4f55\u3067\u3059\u304b\u3002"), (3, "\u0e19\u0e49\u0e33\u0e40\u0e14\u0e37\u0e2d\u0e14\u0e17\u0e35\u0e48\u0e01\u0e35\u0e48\u0e2d\u0e07\u0e28\u0e32"), (4, "\u4f60\u597d"),
             (5, 'one "two" three - four five "six" seven eight nine ten'), (6, "???")]
    rows = [(1, "so: what is 2 plus 2, what is 2 \u2013 2!"), (2, "\u554f\uff1a" + items[1][1].replace("\u4f55", "\u306a") + "\u7b54"), (3, "x " + items[2][1] + "\u0e04\u0e23\u0e31\u0e1a"), (4, "\u4ed6\u8bf4\u4f60\u597d\u5417"),
            (5, "one \u201ctwo\u201d three\u2014four\u00a0five \u201csix\u201d seven eight other words"), (6, "is 2 what 2"), (7, "\u597d\u4f60"), (8, "what is"), (9, "2 2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.annotate(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), bench).collect()
    assert {r["doc_id"]: [h["item"] for h in r["hits"]] for r in got} == {1: [1], 2: [2], 3: [3], 4: [4], 5: [5], 6: [], 7: [], 8: [], 9: []}
    assert {r["doc_id"]: h["end"] for r in got for h in r["hits"] if h["item"] in (1, 4)} == {1: 10, 4: 4}


def test_top_k(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(300, 8)).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(50, v[50]), (400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, v[3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ints = [(i, np.floor(256 * np.array(x, np.float32).astype(float))) for i, x in rows if x is not None and None not in x and np.isfinite(x).all()]
    want = []
    for a, (q, x) in enumerate(ints):
        if q is not None and q % 50 == 0:
            best = sorted(((-int(x @ y), (i is None, i or 0)) for b, (i, y) in enumerate(ints) if a != b))[:5]
            want += [(q, n + 1, None if k[0] else k[1], -s) for n, (s, k) in enumerate(best)]
    from pyspark.sql import functions as F

    got = mtree.search(df, F.col("key") % 50 == 0).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert mtree.search(df.limit(0), F.col("key") % 50 == 0).count() == 0


def test_top_k_of_large_numbers_and_copies(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    base = rng.normal(size=(120, 8))
    copies = [[1.0, 0.0, 0.1, 0.0, 0.0, 0.0, 0.0, 0.7]] * 1300
    last = 2**63 - 1
    for size, more in ((1.0, copies), (1e5, []), (3e6, []), (1e10, []), (1e30, [])):
        x = np.concatenate([base * size * np.where(np.arange(120) % 3 == 0, 1e-4, 1)[:, None], np.array(more).reshape(-1, 8)]).astype(np.float32)
        rows = [(7 * i - 350, v.tolist()) for i, v in enumerate(x)] + [(last, x[0].tolist()), (9999, [])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        ints = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows]
        want = {}
        for q, a in ints:
            if q % 50 == 0:
                best = sorted((-sum(m * n for m, n in zip(a, b)), i) for i, b in ints if i != q)[:5]
                want |= {(q, n + 1): (i, -s if -(2**63) <= -s < 2**63 else None) for n, (s, i) in enumerate(best)}
        got = mtree.search(df, F.col("key") % 50 == 0).collect()
        assert len(got) == len(want) and {(r["query"], r["rank"]): (r["key"], r["score"]) for r in got} == want
    short = spark.createDataFrame([(0, []), (1, []), (2, [])], "vec_id int, embedding array<float>")
    assert sorted(map(tuple, mtree.search(short, F.col("key") % 50 == 0).collect())) == [(0, 1, 1, 0), (0, 2, 2, 0)]


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text: str) -> list[str]:
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            d = re.sub("[^0-9]", "", m[0])
            check = sum(c if i % 2 == 0 else 2 * c - 9 * (c > 4) for i, c in enumerate(map(int, reversed(d))))
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(d) <= 19 and check % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data(spark, docs, none):
    text = dict(texts(spark))
    for r in catalog.op8_pii(spark, SF).collect():
        want = plain_spans(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(filter(None, r["spans"].split(",")))
    odd = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111", "+1 (255) 555-8013 +12", "1 " * 20_000, "9" * 40_000, "ä😀 x@y.zz", "x" * 50_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)] + [(90, None), (91, "")], "doc_id long, text string")
    got = {r["key"]: r["s"] for r in pii.find(df).select("key", pii.joined("base").alias("s")).collect()}
    assert got == {**{i: ",".join(plain_spans(t)) for i, t in enumerate(odd)}, 90: "", 91: ""}
    assert pii.find(docs).count() == len(ROWS) and pii.find(none).count() == 0


def test_votes_find_reliable_labelers():
    post = pii.reliabilities([("222", 50), ("111", 5), ("000", 60), ("202", 5), ("200", 4)])
    assert post["222"] > 0.9 and post["000"] < 0.1


def test_marginals_equal_enumeration():
    from itertools import product

    moves, bias, emission = np.array([[0.3, -0.7], [0.1, 0.4]]), -1.0, [0, 2.0, 0, 0, -0.5, 1.0, 0]
    weight, hit = 0.0, np.zeros(7)
    for path in product((0, 1), repeat=7):
        s = sum(moves[a, b] for a, b in zip((0, *path), path)) + sum(bias + e for y, e in zip(path, emission) if y)
        weight += np.exp(s)
        hit += np.exp(s) * np.array(path)
    at = np.flatnonzero(emission)
    assert np.allclose(toxicity.marginals(at, np.array(emission)[at], 7, bias, moves), (hit / weight)[at])


def test_toxicity(spark, docs, none):
    rows = [(i, ("you awful clown go" if i % 5 == 0 else "a kind word for you") + f" w{i % 50} tail", int(i % 5 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.drop("toxic"), df.drop("text"))
    said = toxicity.score(df, model).collect()
    assert all(r["predicted"] == r["toxic"] and 0 <= r["score"] <= 1 for r in said)
    assert {t["text"][s["start"]:s["end"]] for t in said for s in t["toxic_spans"]} <= {"awful", "clown", "go"}
    assert toxicity.clean(docs, model).columns == docs.columns and toxicity.clean(docs, model).count() == len(ROWS)
    assert toxicity.score(none, model).count() == 0
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(df, df.limit(0))).collect()} == {0.5}


def test_archive(spark, tmp_path):
    big = "payload\r\n\r\nWARC/1.1 ä " * 40_000
    rows = [(1, "u", big), (2, None, big), (3, "u\r\nX: y", "short"), (4, "u", "short"), (5, "u", None), (None, "u", big), (2, "u", big)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record string")
    got = sorted(map(str, map(tuple, warc.round_trip(df).collect())))
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = [(k, len((t or "").encode()), sha(t), "revisit" if t == big and k != 2 else "response", 2 if t == big and k != 2 else None) for k, _, t in rows]
    assert got == sorted(map(str, want))
    assert warc.round_trip(df.limit(0)).count() == 0
    warc.write(df, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).where("chunk > 0").count() >= 3


def test_pipeline(spark):
    import corpus_pipeline

    docs, kept = catalog.table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == catalog.table(spark, SF, "documents").columns
        kept.append(docs.count())
    assert kept[0] >= kept[1] >= kept[2] > 0 and corpus_pipeline.run(spark, SF).count() == kept[3]
