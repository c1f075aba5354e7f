"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and items become lists of words (lower case, runs of letters and digits; in scripts without spaces every character
is a word; spaces, punctuation and symbols separate, beyond ASCII too). A text is contaminated by an item of n words if some passage of it is within edit distance
floor(0.2 n) of the whole item, words being the symbols.

Windows as long as an item start at every word. A window with too few pairs and triples of neighbouring words that occur
in the benchmark at all cannot be that close and is passed over (a lossless test: k edits leave all but 2 k of an item's
pairs, all but 3 k of its triples, and all but k of its distinct words). The others are embedded by CGK random walks: a step emits the word under
the pointer and the pointer moves on or stays by a random bit of (step, word), so few edits become few differing
positions of strings three times as long. Each of several repetitions has its own bits and sampled positions; their number
follows from the target recall. Windows that share a sample with an item are verified by the exact edit distance.

Windows come in length classes a tenth apart; an item belongs to the class at or below its length and is verified whole.
Items of fewer than five words allow no edit and are found by the hash of all their words. The benchmark is cut into
blocks of bounded size, each is sent to the tasks in turn; texts are read once for each block and never shuffled.

Null and empty texts and items never match. An empty benchmark gives no hits. Repeated items all hit, repeated rows get
equal hits; extra columns pass through.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import free, mix64, runs, utf8, whole

RATE = 0.2  # edits for each word of an item
BLOCK_CHARS = 4 << 20
SAMPLED = 2  # positions in one sample
AGREE = 0.66  # share of equal positions of the embeddings of a passage and its item for the best of the windows around it
PRIME = 0x9E3779B97F4A7C15
PIECE = 1 << 20
CELLS = 1 << 20  # words of windows or regions that are laid out at once
CLASS_BITS = 18


#: Scripts without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han, and their extensions.
UNSPACED = ((0xE00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1AB0), (0x2E80, 0x3130), (0x31A0, 0x3200), (0x3400, 0xA4D0),
            (0xA9E0, 0xAA00), (0xAA60, 0xAAE0), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x16FE0, 0x18D80), (0x1AFF0, 0x1B300), (0x20000, 0x40000))


def character_kinds() -> tuple[np.ndarray, np.ndarray]:
    """First code points of ranges and their kind: 0 separates, 1 is part of a word, 2 is a word."""
    joins = "\u200c\u200d"
    kinds = np.array([unicodedata.category(chr(c))[0] in "LMN" or chr(c) in joins for c in range(sys.maxunicode + 1)], np.uint8)
    for a, b in UNSPACED:
        kinds[a:b] *= 2
    starts = np.flatnonzero(np.diff(kinds, prepend=3))
    return starts.astype(np.int32), kinds[starts]


RANGES = character_kinds()


def wide_kinds(b: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bytes of UTF-8 that belong to characters beyond ASCII: 0 where they separate; `begins` is set where one is a word."""
    out = np.ones(len(b), bool)
    for low, high, n in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        at = np.flatnonzero((b >= low) & (b < high))
        at = at[at + n <= len(b)]
        code = (b[at] & (0x7F >> n)).astype(np.int32)
        for i in range(1, n):
            code = code << 6 | (b[at + i] & 0x3F)
        kind = RANGES[1][np.searchsorted(RANGES[0], code, "right") - 1]
        for i in range(n):
            out[at + i] = kind > 0
        begins[at[kind == 2]] = True
        begins[at[kind == 2] + n] = True
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and the index of the first word of each text."""
    kind = np.zeros(256, np.uint8)
    kind[48:58], kind[97:123] = np.arange(48, 58), np.arange(97, 123)
    kind[65:91], kind[128:] = np.arange(97, 123), np.arange(128, 256)
    hashes, places = [], []
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + PIECE, end)
        while to < end and kind[data[to]]:  # no word is cut, not even between texts
            to = min(to + PIECE, to + 1 + int(np.argmax(np.append(kind[data[to:to + PIECE]] == 0, True))), end)
        b = kind[data[at:to]]
        inside = b > 0
        edge = np.zeros(len(b) + 1, bool)
        if (b > 127).any():
            inside &= wide_kinds(data[at:to], edge)
        cuts = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to)] - at
        edge[cuts] = True
        first = inside & (edge[:-1] | ~np.append(False, inside[:-1]))
        last = inside & (edge[1:] | ~np.append(inside[1:], False))
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, back = powers(len(b) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        hashes.append(mix64((total[e] - total[s]) * back[s]))
        places.append(s + at)
        at = to
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    return h, np.searchsorted(where, offsets)


def slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def neighbours(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs and of the triples of neighbouring words."""
    pairs = mix64(h[:-1] * np.uint64(PRIME) + h[1:])
    return pairs, mix64(pairs[:-1] * np.uint64(PRIME) + h[2:])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of PRIME and of its inverse."""
    out = []
    for x in (PRIME, pow(PRIME, -1, 1 << 64)):
        p = np.full(n, x, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def size_class(n: int) -> int:
    return min(n, math.ceil(1.1 ** math.floor(math.log(n + 0.5, 1.1)) - 1e-9)) if n > 10 else n


def repetitions(recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - AGREE**SAMPLED))


def sample_keys(words: np.ndarray, starts: np.ndarray, size: int, rep: int) -> np.ndarray:
    """One sample of the CGK embedding of windows of `size` words: a hash of the words at the sampled positions."""
    rng = np.random.default_rng([rep, size])
    steps = np.sort(rng.choice(3 * size, SAMPLED, replace=False))
    salts = rng.integers(1, 2**63, 3 * size).astype(np.uint64)
    at, end = starts.copy(), starts + size
    key = np.full(len(starts), rep, np.uint64)
    for j in range(int(steps[-1]) + 1):
        symbol = np.where(at < end, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        if j in steps:
            key = mix64(key * np.uint64(PRIME) + symbol)
        at += (mix64(symbol ^ salts[j]) & np.uint64(1)).astype(np.int64)
    return key


def edit_distances(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance between the item and a stretch of each region, and where that stretch ends."""
    row = np.zeros((len(regions), regions.shape[1] + 1), np.int32)
    along = np.arange(row.shape[1], dtype=np.int32)
    for i, w in enumerate(item):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (regions != w))
        row = np.minimum.accumulate(new - along, axis=1) + along
    at = row.argmin(1)
    return row[np.arange(len(row)), at], at


@dataclass
class Block:
    """One block of the benchmark: words of its items, and sorted samples by class and repetition."""

    ids: list
    words: list[np.ndarray]
    known: list[np.ndarray]  # marks of the pairs and of the triples that occur
    short: dict[int, dict[int, list[int]]]  # items that allow no edit, by number of words and hash
    classes: list[tuple]  # window; known pairs, triples and distinct words it needs; marks of the class's pairs; samples by repetition


def joined_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        out = mix64(out * np.uint64(PRIME) + h[i:i + len(out)])
    return out


def make_block(ids: list, texts: list[str], recall: float) -> Block:
    data, offsets = utf8(pa.array(texts, pa.string()))
    h, first = word_hashes(data, offsets)
    words = [h[a:b] for a, b in zip(first, first[1:])]
    bits = min(24, max(16, len(h).bit_length() + 8))
    known = [np.zeros(1 << bits, bool) for _ in range(2)]
    for w in words:
        for marks, grams in zip(known, neighbours(w)):
            marks[slots(grams, bits)] = True
    of: dict[int, list[int]] = {}
    short: dict[int, dict[int, list[int]]] = {}
    for i, w in enumerate(words):
        if int(RATE * len(w)):
            of.setdefault(size_class(len(w)), []).append(i)
        elif len(w):
            short.setdefault(len(w), {}).setdefault(int(joined_hashes(w, len(w))[0]), []).append(i)
    classes = []
    for size, members in sorted(of.items()):
        starts = first[members].astype(np.int64)
        samples = []
        for rep in range(repetitions(recall)):
            key = sample_keys(h, starts, size, rep)
            order = np.argsort(key, kind="stable")
            samples.append((key[order], np.array(members)[order]))
        most = max(int(RATE * len(words[i])) for i in members)
        distinct = min(len(np.unique(words[i])) - int(RATE * len(words[i])) - (len(words[i]) - size) for i in members)
        own = np.zeros(1 << CLASS_BITS, bool)
        for i in members:
            own[slots(neighbours(words[i])[0], CLASS_BITS)] = True
        classes.append((size, max(0, size - 1 - 2 * most), max(0, size - 2 - 3 * most), distinct, own, samples))
    return Block(ids, words, known, short, classes)


def find(block: Block, h: np.ndarray, first: np.ndarray) -> dict[int, dict[int, tuple[int, int]]]:
    """For each text with hits: item index to (edits, last word of the passage, counted from the text's first)."""
    out: dict[int, dict[int, tuple[int, int]]] = {}
    for n, items in block.short.items():
        got = joined_hashes(h, n)
        keys = np.sort(np.array(list(items), np.uint64))
        at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, got), len(keys) - 1)] == got)
        text = np.searchsorted(first, at, "right") - 1
        inside = at + n <= first[text + 1]
        at, text = at[inside], text[inside]
        one = np.unique(np.stack([text.astype(np.uint64), got[at]]), axis=1, return_index=True)[1]  # the first of each in a text
        for p, t in zip(at[one].tolist(), text[one].tolist()):
            for i in items[int(got[p])]:
                out.setdefault(t, {})[i] = (0, p + n - int(first[t]))
    if not block.classes:
        return out
    bits = len(block.known[0]).bit_length() - 1
    pairs, triples = (np.cumsum(np.concatenate([[False], marks[slots(grams, bits)], np.zeros(len(h) - len(grams), bool)]), dtype=np.int32)
                      for marks, grams in zip(block.known, neighbours(h)))
    power, back = powers(len(h) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1])])
    pair_slots = np.append(slots(neighbours(h)[0], CLASS_BITS), 0)
    for size, need_pairs, need_triples, need_words, own, samples in block.classes:
        # grams that begin in a window; a text may be shorter than the window
        stop = np.minimum(np.arange(len(h)) + size, len(h))
        start = np.flatnonzero((pairs[stop] - pairs[:-1] >= need_pairs) & (triples[stop] - triples[:-1] >= need_triples))
        text = np.searchsorted(first, start, "right") - 1
        likely = np.zeros(len(start), bool)
        for a in range(0, len(start), max(1, CELLS // size)):  # so many windows that their words take bounded memory
            part = slice(a, a + max(1, CELLS // size))
            span, end = start[part, None] + np.arange(size), first[text[part] + 1][:, None]
            joined = own[pair_slots[np.minimum(span[:, :-1], len(h) - 1)]] & (span[:, 1:] < end)
            some = np.flatnonzero(joined.sum(1) >= need_pairs)
            span, end = span[some], end[some]
            inside = np.sort(np.where(span < end, h[np.minimum(span, len(h) - 1)], np.uint64(0)), axis=1)
            likely[a + some[1 + (inside[:, 1:] != inside[:, :-1]).sum(1) >= need_words]] = True
        start, text = start[likely], text[likely]
        # of windows with equal surroundings in the same text (repeated words, lines), one stands for all
        reach = 1 + max(int(RATE * len(block.words[i])) * 2 + len(block.words[i]) for i in samples[0][1])
        lo, hi = np.maximum(start - reach + size, first[text]), np.minimum(start + reach, first[text + 1])
        around = (total[hi] - total[lo]) * back[lo] ^ mix64((start - lo).astype(np.uint64) << np.uint64(32) ^ text.astype(np.uint64))
        one = np.unique(around, return_index=True)[1]
        start, text = start[one], text[one]
        if not len(start):
            continue
        found = []
        for rep, (keys, members) in enumerate(samples):
            got = sample_keys(h, start, size, rep)
            lo, hi = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
            n = hi - lo
            rows = np.repeat(np.arange(len(start)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            found.append(np.stack([members[at], start[rows], text[rows]], axis=1))
        shared = np.concatenate(found)
        for i in np.unique(shared[:, 0]):
            item = block.words[i]
            k = int(RATE * len(item))
            mine = shared[shared[:, 0] == i]
            _, one = np.unique(mine[:, 2] * (len(h) + 1) + mine[:, 1] // (k + 1), return_index=True)
            mine = mine[one]
            reach = np.arange(-2 * k - 1, len(item) + 2 * k + 1)
            step = max(1, min(4096, CELLS // len(reach)))
            for a in range(0, len(mine), step):
                part = mine[a:a + step]
                where = part[:, 1][:, None] + reach
                ok = (where >= first[part[:, 2]][:, None]) & (where < first[part[:, 2] + 1][:, None])
                regions = np.where(ok, h[np.clip(where, 0, len(h) - 1)], np.uint64(0))
                edits, end = edit_distances(item, regions)
                for (_, p, t), e, z in zip(part.tolist(), edits.tolist(), end.tolist()):
                    if e <= k:
                        hits = out.setdefault(t, {})
                        new = (e, p + int(reach[0]) + z - int(first[t]))
                        hits[int(i)] = min(hits.get(int(i), new), new)
    return out


def _searcher(block: Block, kind: str, shape: str):
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    hit = pa.struct([("item", arrow), ("edits", pa.int32()), ("end", pa.int64())])

    @F.arrow_udf(shape)
    def hits(texts: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for i, j in runs(offsets, 4 * PIECE):
            h, first = word_hashes(data, offsets[i:j + 1])
            for t, got in find(block, h, first).items():
                out[i + t] = sorted(({"item": block.ids[k], "edits": e, "end": z} for k, (e, z) in got.items()),
                                    key=lambda x: (x["item"] is None, x["item"]))
        return pa.array(out, pa.list_(hit))

    return hits


def annotate(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
             recall: float = 0.99, name: str = "hits") -> DataFrame:
    """Adds an array of (item, edits, end): the items found, the edits of the best passage and the word after it."""
    chars = benchmark.agg(F.sum(F.octet_length(whole(item_text)))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    kind = benchmark.schema[item].dataType.simpleString()
    shape = f"array<struct<item:{kind},edits:int,end:long>>"
    found = [F.array().cast(shape)]
    (lowered,) = free(df, "lowered")
    items = benchmark.select(F.col(item).alias("i"), F.lower(whole(item_text)).alias("t"))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == b).collect()  # about BLOCK_CHARS
        block = make_block([r["i"] for r in rows], [r["t"] for r in rows], recall)

        if block.classes or block.short:
            found.append(_searcher(block, kind, shape)(F.col(lowered)))
    df = df.withColumn(lowered, F.lower(whole(text)))
    return df.withColumn(name, F.concat(*found)).drop(lowered)


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows whose text holds no item."""
    (hits,) = free(df, "hits")
    return annotate(df, benchmark, text, name=hits, **options).where(F.size(hits) == 0).drop(hits)
