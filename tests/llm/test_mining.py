"""Hard negatives, whitening, pieces, and what toxicity learns, against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from issueloom.llm import catalog, decontam, hardneg, pieces, pii, toxicity, warc, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, score double, rank string"


def plain_negatives(rows, is_anchor, scale=256, positives=5, negatives=5, low=80):
    """(anchor, positive, rank, negative, positive_score, negative_score) by comparing all pairs with big integers."""
    import math

    size = max((len(v) for _, v, _ in rows), default=0)
    whole = [(i, k, [math.floor(scale * float(np.float32(c))) for c in v] + [0] * (size - len(v)), lab) for i, (k, v, lab) in enumerate(rows)]
    null_last = lambda k: (k is None, k or 0)
    out = []
    for i, k, v, lab in whole:
        if k is None or not is_anchor(k):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), null_last(q), j, q, other) for j, q, w, other in whole if j != i))
        for s, _, _, p, _ in [x for x in scored if x[4] == lab][:positives]:
            fit = [x for x in scored if x[4] != lab and low * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(k, p, r + 1, q, -s, -t) for r, (t, _, _, q, _) in enumerate(fit)]
    return sorted(map(str, out))


def mined(spark, rows, **options):
    df = spark.createDataFrame([(k, v, lab, 0.5, "x") for k, v, lab in rows], VECTORS)
    return sorted(str(tuple(r)) for r in hardneg.mine(df, **options).collect())


def test_packed_products():
    rng = np.random.default_rng(1)
    for size, top in ((64, 130), (3, 2), (8, 2**20), (5, 2**28), (1, 0)):
        v = rng.integers(-top, top + 1, (101, size))
        a = rng.integers(-top, top + 1, (7, size))
        both = np.concatenate([v, a])
        packing = hardneg.Packing(size, int(both.min()), float((both.astype(float) ** 2).sum(1).max()), int(both.sum(1).max()))
        want = a.astype(object) @ v.T.astype(object)
        assert (packing.scores(a, packing.read(packing.write(v), len(v)), v.sum(1)) == want).all()
        assert packing.fields >= 2 or packing.width > 32


def test_hard_negatives(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)], int(rng.integers(0, 3))) for i in range(300)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 2), (None, rows[3][1], 1), (3, rows[3][1], rows[3][2])]  # repeated keys, ties, no key
    rows += [(1000, rows[0][1], 0)] + [(2000 + i, rows[0][1], 1) for i in range(80)]  # a hot vector
    anchors = catalog.F.col("key") % 20 == 0
    assert mined(spark, rows, anchors=anchors) == plain_negatives(rows, lambda k: k % 20 == 0)
    odd = [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 6, 1), (903, [float("inf")] * 6, 2), (904, [1.0] * 6, None)]
    assert mined(spark, rows + odd, anchors=anchors) == mined(spark, rows, anchors=anchors)
    short = [(0, [1.0, 2.0], 0), (1, [1.0], 0), (2, [1.0, 1.9], 1), (3, [], 1), (20, [-1.0], 0)]
    assert mined(spark, short, anchors=anchors) == plain_negatives(short, lambda k: k % 20 == 0)
    assert mined(spark, [], anchors=anchors) == [] and mined(spark, [(0, [], 1)], anchors=anchors) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)], anchors=anchors) == []


def test_hard_negatives_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "CANDIDATES", 16)
    monkeypatch.setattr(hardneg, "ANCHORS", 4)
    monkeypatch.setattr(hardneg, "GROUP_CANDIDATES", 3)
    monkeypatch.setattr(hardneg, "GROUP_ANCHORS", 2)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=4)], 0 if i % 3 else int(rng.integers(0, 40))) for i in range(400)]
    assert mined(spark, rows, anchors=catalog.F.col("key") % 10 == 0) == plain_negatives(rows, lambda k: k % 10 == 0)


def plain_whitening(vectors, components=8):
    """Exact deviations, and whitened rows by the covariance's eigenvectors."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    c = (x - s // n) - (s % n) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    keep = [i for i in np.argsort(-e)[:components] if e[i] > 1e-9 * max(e.sum(), 1e-9)]
    return ((n * x - s) ** 2).sum(1), c @ v[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum()


def whitened(spark, rows):
    df = spark.createDataFrame([(k, v, 1, 0.5, "x") for k, v in rows], VECTORS)
    out = whitening.whiten(df).toPandas()
    return out, out.pivot_table(index="key", columns="component", values="whitened").sort_index().values


@pytest.mark.parametrize("kind", ["spread", "flat", "low rank", "wide", "repeated"])
def test_whitening(spark, kind):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(200, 12)) * (2.0 ** -np.arange(12) if kind == "spread" else 1)
    if kind == "low rank":
        v = v[:, :3] @ rng.normal(size=(3, 12)) * 40
        v = np.round(v)
    if kind == "wide":
        v = v[:5]
    if kind == "repeated":
        v = np.repeat(v[:20], 10, axis=0)
    out, got = whitened(spark, [(i, [float(c) for c in row]) for i, row in enumerate(v)])
    deviation, want, share = plain_whitening(v)
    assert got.shape == want.shape and np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-8)
    first = out[out.component == 1].sort_values("key")
    assert (first.deviation.values == deviation).all() and (out.n == len(v)).all() and out.identity_error.max() < 1e-9
    assert np.allclose(out.drop_duplicates("component").sort_values("component").explained, share)


def test_whitening_finds_repeated_deviations(spark):
    v = np.concatenate([np.eye(10), -np.eye(10)])  # all ten deviations are equal
    out, got = whitened(spark, [(i, [float(c) for c in row]) for i, row in enumerate(v)])
    c = got - got.mean(0)
    assert got.shape == (20, 8) and np.allclose(c.T @ c / 20, np.eye(8), atol=1e-9)


def test_whitening_of_odd_tables(spark):
    good = [(i, [float(i), float(i * i % 7)]) for i in range(30)]
    odd = [(50, None), (51, [1.0, None]), (52, [float("nan"), 1.0]), (53, [float("-inf"), 0.0])]
    a, _ = whitened(spark, good)
    b, _ = whitened(spark, good + odd)
    assert np.allclose(np.abs(a.sort_values(["key", "component"]).whitened), np.abs(b.sort_values(["key", "component"]).whitened)) and set(b.key) == set(range(30))
    none = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(none).count() == 0
    assert whitened(spark, [(1, [2.0, 3.0])] * 4)[0].empty  # no spread, no component
    null_key = spark.createDataFrame([(None, [1.0], 1, 0.0, ""), (None, [2.0], 1, 0.0, "")], VECTORS)
    assert whitening.whiten(null_key).count() == 2


def test_whitening_query(spark):
    rows = catalog.op12_whitening(spark, SF).toPandas()
    table = catalog.table(spark, SF, "embeddings").toPandas().sort_values("vec_id")
    deviation, want, _ = plain_whitening(list(table.embedding))
    got = rows.pivot(index="vec_id", columns="component", values="whitened").sort_index().values
    assert np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-9)
    assert (rows[rows.component == 1].sort_values("vec_id").deviation.values == deviation).all()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=catalog.pieces_path())


@pytest.fixture(scope="module")
def model():
    return pieces.load(catalog.pieces_path())


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_pieces_equal_the_library(model, library):
    rng, names = random.Random(1), [p.replace(pieces.SPACE, " ") for p, k in zip(model.pieces, model.kinds) if k == "n"]
    odd = ["", " ", "   ", "\n", "\t", "▁", "é", "é", "日", "😀", "\x00", "<s>", "</s>", "<0x0A>", "<unk>", "ﬁ", "Ａ", "=", "--", "/"]
    encoder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    for _ in range(4000):
        text = "".join(rng.choice(odd) if rng.random() < 0.4 else rng.choice(names) if rng.random() < 0.7 else chr(rng.randint(1, 0x3000)) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert encoder.ids(text) == packed(ids) and decoder.text(packed(ids)) == library.decode(ids), text
    for _ in range(2000):  # ids that no text has
        ids = [rng.choice([rng.randint(0, 258), rng.randint(0, len(names)), 28705, 259]) for _ in range(rng.randint(0, 12))]
        assert decoder.text(packed(ids)) == library.decode(ids), ids
    for text in ("a" * 300_000, " " * 100_000, "ab" * 150_000 + "日" * 1000, "the quick " * 30_000 + "x" * 300_000 + " the quick" * 9000):
        assert encoder.ids(text) == packed(library.encode(text, add_bos=True, add_eos=True))


def test_pieces_when_memos_are_full(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "UNITS", 3)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    monkeypatch.setattr(pieces, "SLICE", 7)
    encoder = pieces.Encoder(model)
    for text in ("one two  three\n\nfour five, six", " lead and trail ", "une phrase plutôt longue " * 20):
        assert encoder.ids(text) == packed(library.encode(text, add_bos=True, add_eos=True))


def test_pieces_column(spark, model, library):
    rows = [(1, "some text", "x", 1.5), (2, None, None, None), (3, "", "y", 0.0), (None, "some text", "z", 2.0), (1, "some text", "x", 1.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded double")
    coded = pieces.encode(df, model)
    assert coded.columns == ["doc_id", "text", "ids", "decoded", "ids_"]
    back = pieces.decode(coded, model, "ids_").collect()
    for r in back:
        assert bytes(r["ids_"]) == packed(library.encode(r["text"] or "", add_bos=True, add_eos=True)) and r["decoded_"] == (r["text"] or "")
    both = pieces.round_trip(df, model)
    assert both.columns == ["doc_id", "text", "ids", "decoded", "ids_", "decoded_"]
    assert sorted(map(str, both.collect())) == sorted(map(str, back))
    assert pieces.decode(spark.createDataFrame([(None,)], "ids binary"), model).first()["decoded"] == ""
    assert pieces.encode(df.limit(0), model).count() == 0


def test_pieces_query(spark, library):
    text = {r["doc_id"]: r["text"] or "" for r in catalog.table(spark, SF, "documents").collect()}
    rows = catalog.op13_sentencepiece(spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = library.encode(text[r["doc_id"]], add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in catalog.table(spark, sf, "labels").collect() if r["toxic"] is not None}
    rows = [r for r in catalog.op9_toxicity(spark, sf).collect() if r["doc_id"] in toxic and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(rows) > 50 and np.mean([r["predicted"] == toxic[r["doc_id"]] for r in rows]) > 0.9


def test_toxicity_windows_come_from_the_whole_text(spark):
    rows = [(i, " ".join(f"word{j}" for j in range(400)) + (" awful clown" * 3 if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"), windows_of_text=4)
    assert all(r["predicted"] == r["toxic"] for r in toxicity.score(df, model).collect())
    twice = df.select("doc_id", "toxic").unionByName(df.select("doc_id", "toxic"))
    assert toxicity.fit(df, twice, windows_of_text=4).scores == model.scores  # repeated labels change nothing


def plain_warc(data):
    """(headers, payload) of the records of an archive, by the format's rules."""
    out = []
    while data:
        assert data.startswith(b"WARC/1.1\r\n")
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        out.append((fields, rest[:size]))
        assert rest[size:size + 4] == b"\r\n\r\n"
        data = rest[size + 4:]
    return out


def test_archives_are_plain_warc(spark, tmp_path):
    big = "payload ä\r\n\r\nWARC/1.1\r\n" * 30_000
    rows = [(7, "http://a.test/1", "one"), (7, "http://a.test/2", "two"), (None, None, "three"), (8, "http://a.test/8", big), (9, "http://a.test/9", big), (9, "http://a.test/9", "x"), (4, None, None)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), date="2031-05-06T07:08:09Z")
    chunks = sorted(spark.read.parquet(str(tmp_path / "w")).collect(), key=lambda r: (r["record"], r["chunk"]))
    data = b"".join(bytes(r["block"]) + (b"\r\n\r\n" if r["last"] else b"") for r in chunks)
    records = plain_warc(data)
    ids = [f["WARC-Record-ID"] for f, _ in records]
    assert len(records) == len(rows) and len(set(ids)) == len(ids)
    assert all(f["WARC-Date"] == "2031-05-06T07:08:09Z" and f["Content-Type"] and f["WARC-Type"] in ("response", "revisit") for f, _ in records)
    for f, payload in records:
        if f["WARC-Type"] == "response":
            assert f["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
        else:
            assert (f["X-Page-ID"], f["X-Refers-To-Page"], f["WARC-Refers-To-Target-URI"], payload) == ("8", "9", "http://a.test/9", b"")
    assert sorted(p.decode() for _, p in records) == sorted(["one", "two", "three", "", big, "x", ""])


def test_very_many_matches_in_one_text(spark):
    many = 100_000
    text = " ".join(["1.2.3.4", "x@y.zz", "555-010-2233"] * (many // 3)) + " mail me at a (at) b.com"
    df = spark.createDataFrame([(1, text), (2, "call 555-010-2233 now"), (3, None)], "doc_id long, text string")
    got = {r["key"]: r for r in pii.find(df).collect()}
    assert (got[1]["n_ip"], got[1]["n_email"], got[2]["n_ip"], got[3]["n_phone"]) == (many // 3, many // 3, 0, 0)
    assert [tuple(x) for x in got[1]["base"][-1:]] == [(1, 28 * (many // 3 - 1) // 1, 28 * (many // 3 - 1) + 7)]
    assert all(text[x["s"]:x["e"]] == "x@y.zz" for x in got[1]["base"][:50])


def test_a_long_item_repeated_in_a_long_text_takes_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(12)
    item = " ".join(f"w{int(x)}" for x in rng.integers(0, 5000, 1000))
    text = (item + " ") * (100_000 // len(item))
    block = decontam.make_block([7], [item], 0.99)
    data, offsets = decontam.utf8(catalog_array([text]))
    h, first = decontam.word_hashes(data, offsets)
    tracemalloc.start()
    got = decontam.find(block, h, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0][0][0] == 0 and peak < 250e6


def catalog_array(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())
