"""Token ids in a Simple-8b file.

A 64-bit word holds a 4-bit selector (high bits) and 60 data bits: selectors 1 to 14 pack 60 ids of one bit down to one id
of 60 bits, first id in the low bits. Selector 15 is the escape: the next word is one raw 64-bit value. Each text's ids
(with the end id) start at a word of their own. A file is a Parquet table of blocks in the order of the key; a block has
the keys of its texts, their id counts, the word at which each starts, the ids before it in its part (one part for each
writing task), and the words as little-endian bytes. All ids of a block decode with a few array operations.

Texts are encoded by the given tokenizer as they are (null: empty). Units between single spaces or line feeds are encoded
once and remembered while the memo is below its bound; this equals encoding the whole text, as a byte-level splitter
always starts a new piece there. Texts with other white space or characters outside the Latin range, where that isn't
certain, are encoded as a whole.

Null keys come first, rows with equal keys follow each other in any order, an empty table gives a file without blocks.
Other columns are not stored. Writing is a normal Spark write and so survives lost executors.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import fresh_path
from .common import runs, utf8, whole

PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
SIZES = np.array([0] + [c for c, _ in PACKS] + [1])  # values by selector
BIT_LENGTH = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)
BLOCK_BYTES = 1 << 19  # of text, unless a single text is longer
MEMO = 400_000
#: Next to these characters a single space or line feed always ends a piece; anything else is left to the tokenizer.
ODD = re.compile("[^\n !-~À-ɏ]")
LETTERS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")


def _window_maxima(bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each pack, small counts first, the largest of `count` values from each position on (255 beyond the end)."""
    power, size = bits, 1
    for s in range(len(PACKS), 0, -1):
        c = PACKS[s - 1][0]
        while 2 * size <= c:
            grown = np.full_like(power, 255)
            grown[:-size] = np.maximum(power[:-size], power[size:])
            power, size = grown, 2 * size
        most = power.copy()
        if c > size:
            most[:size - c] = np.maximum(power[:size - c], power[c - size:])
            most[size - c:] = 255
        yield s, most


def pack(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of consecutive id lists (uint64), and the number of words of each list."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(lengths), np.int64)
    bits, high = BIT_LENGTH[ids & ids.dtype.type(0xFFFF)], ids
    for shift in (16, 32, 48):
        high = high >> high.dtype.type(16)
        if not high.any():
            break
        bits = np.where(high > 0, shift + BIT_LENGTH[high & high.dtype.type(0xFFFF)], bits).astype(np.uint8)
    bits = np.append(bits, np.full(64, 255, np.uint8))  # so that every window exists
    left = np.minimum(np.repeat(np.cumsum(lengths), lengths) - np.arange(n), 64).astype(np.uint8)
    code = np.full(n, ESCAPE, np.uint8)
    for s, most in _window_maxima(bits):
        c, width = PACKS[s - 1]
        code[(most[:n] <= width) & (left >= c)] = s
    count = SIZES[code]
    step, starts, at = count.tolist(), [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts)
    kinds = code[starts]
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(kinds == ESCAPE)[:-1]])
    words = np.zeros(len(starts) + int(np.count_nonzero(kinds == ESCAPE)), np.uint64)
    for s, (c, width) in enumerate(PACKS):
        rows = kinds == s + 1
        if rows.any():
            v = ids[starts[rows][:, None] + np.arange(c)].astype(np.uint64) << (np.arange(c, dtype=np.uint64) * np.uint64(width))
            words[place[rows]] = np.bitwise_or.reduce(v, axis=1) | np.uint64(s + 1) << np.uint64(60)
    raw = kinds == ESCAPE
    words[place[raw]] = np.uint64(ESCAPE) << np.uint64(60)
    words[place[raw] + 1] = ids[starts[raw]]
    ends = np.searchsorted(starts, np.cumsum(lengths))
    bound = np.append(place, len(words))[ends]
    return words, np.diff(np.concatenate([[0], bound]))


def unpack(words: np.ndarray) -> np.ndarray:
    """All ids of words."""
    kinds = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(kinds == ESCAPE):
        if not raw[at]:
            raw[at + 1] = True
    sizes = np.where(kinds == ESCAPE, 0, SIZES[kinds])
    sizes[raw] = 1
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint64)
    for s, (c, width) in enumerate(PACKS):
        rows = (kinds == s + 1) & ~raw
        if rows.any():
            v = words[rows][:, None] >> (np.arange(c, dtype=np.uint64) * np.uint64(width))
            out[at[rows][:, None] + np.arange(c)] = v & np.uint64((1 << width) - 1)
    out[at[raw]] = words[raw]
    return out


def odd(text: str) -> bool:
    return (not text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
            or ODD.search(text) is not None)


class Memo(dict):
    """Ids of units with the same first character (none or a space), learned on demand. Beyond the bound, units that were
    not used since the last time are forgotten."""

    def __init__(self, tokenizer, lead: str) -> None:
        self.tokenizer, self.lead, self.old = tokenizer, lead, {}
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: other bytes from 256 on
        others = [b for b in range(256) if b not in letters]
        self.table = {**{b: b for b in letters}, **{b: 256 + i for i, b in enumerate(others)}}
        self.mark = lead.translate(self.table)

    def _one(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(self.table))]).tobytes()

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        got = self.old.get(unit)
        if got is not None:
            pass
        elif unit.isalpha() and unit.isascii():
            got = array("I", [t.id for t in self.tokenizer.model.tokenize(self.mark + unit)]).tobytes()
        else:
            plain = LETTERS.fullmatch(self.lead + unit)
            if plain:  # one run of letters, then one run of marks: each is a piece of its own
                got = self._one(plain[1]) + (self._one(plain[2]) if plain[2] else b"")
            else:
                got = array("I", self.tokenizer.encode_batch_fast([self.lead + unit], add_special_tokens=False)[0].ids).tobytes()
        self[unit] = got
        return got


class Encoder:
    """Texts to little-endian 32-bit ids."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.first, self.next = Memo(self.tokenizer, ""), Memo(self.tokenizer, " ")
        self.feed = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes() if text else b""

    def encode(self, text: str) -> bytes:
        if odd(text):
            return self.whole(text)
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.first[first] + b"".join(map(self.next.__getitem__, rest)))
        return self.feed.join(out)


def encoder(tokenizer_json: str) -> Encoder:
    """One encoder for each tokenizer and Python worker, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = sys.modules.setdefault("unit_memo_of_worker", ModuleType("unit_memo_of_worker")).__dict__
    name = f"encoder_{zlib.crc32(tokenizer_json.encode())}"
    if name not in kept:
        kept[name] = Encoder(tokenizer_json)
    return kept[name]


def write(df: DataFrame, path: str, tokenizer_json: str, text: str = "text", key: str = "doc_id", end_id: int = 2) -> None:
    """Encode whole texts and write them in the order of the key."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), whole(text).alias("t"), F.monotonically_increasing_id().alias("tie"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt out before encoding: finding the ranges reads the input once more, and encoding must not run twice
    rows = rows.repartitionByRange(tasks, "key", "tie").sortWithinPartitions("key", "tie")
    kind = rows.schema["key"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer_json), array("I", [end_id]).tobytes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            texts, keys = batch["t"], batch["key"]
            _, offsets = utf8(texts)
            for i, j in runs(offsets, BLOCK_BYTES):
                each = [coder.encode(t) + end for t in texts.slice(i, j - i).to_pylist()]
                counts = np.array([len(x) // 4 for x in each], np.int64)
                words, taken = pack(np.frombuffer(b"".join(each), "<u4"), counts)
                one = pa.array([0, j - i], pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "before": pa.array([before], pa.int64()),
                    "keys": pa.ListArray.from_arrays(one, keys.slice(i, j - i)), "counts": pa.ListArray.from_arrays(one, pa.array(counts)),
                    "word_at": pa.ListArray.from_arrays(one, pa.array(np.cumsum(taken) - taken)),
                    "words": pa.array([words.astype("<u8").tobytes()], pa.binary())})
                block, before = block + 1, before + int(counts.sum())

    schema = f"part int, block int, before long, keys array<{kind}>, counts array<long>, word_at array<long>, words binary"
    rows.select("key", "t").mapInArrow(blocks, schema).write.parquet(path)


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(key, start, n, ids_crc32, ids) decoded from the file; start counts the ids of all texts before."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
    first = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, keys, counts, words in zip(*(batch[c] for c in ("part", "before", "keys", "counts", "words"))):
                all_ids = unpack(np.frombuffer(words.as_buffer(), "<u8"))
                counts = np.array(counts.as_py(), np.int64)
                ends = np.cumsum(counts)
                flat = all_ids.astype("<u4")
                out = {"part": pa.array(np.full(len(counts), part.as_py(), np.int32)), "key": keys.values,
                       "at": pa.array(before.as_py() + ends - counts), "n": pa.array(counts),
                       "ids_crc32": pa.array([zlib.crc32(flat[e - c:e]) for e, c in zip(ends, counts)], pa.int64())}
                if ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(all_ids.astype(np.int64)))
                yield pa.RecordBatch.from_pydict(out)

    schema = f"part int, key {kind}, at long, n long, ids_crc32 long" + ", ids array<long>" * ids
    rows = blocks.select("part", "before", "keys", "counts", "words").mapInArrow(decode, schema)
    rows = rows.join(F.broadcast(first), "part")  # a row for each writing task: small by construction
    return rows.select("key", (F.col("base") + F.col("at")).alias("start"), "n", "ids_crc32", *["ids"] * ids)


def round_trip(df: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", end_id: int = 2) -> DataFrame:
    """Write a new file into the shared folder and read it back without the ids themselves."""
    path = fresh_path(df.sparkSession, "tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        write(df, path, f.read(), text, key, end_id)
    return read(df.sparkSession, path, ids=False)
