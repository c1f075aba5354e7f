"""Near duplicates by SimHash with Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into three segments. Two fingerprints with at most two differing bits agree in at least
one segment (pigeonhole), and in the next segment they differ by two bits at most. The binary Golay code (23, 12) has a
codeword within three bits of every word, so two words that differ by two bits have a common codeword within four bits:
the one closest to a word halfway between them. A segment is therefore decoded to all codewords within four bits (one or
six), and every key joins one segment as it is with one codeword index of the next. Linked fingerprints share a key.

`components_of` links fingerprints exactly: keys name the candidates; among these, two fingerprints differ by two bits
at most if and only if they share a neighbour at one bit or less, so verified links go through that neighbour and a group
of n close fingerprints takes O(n) rows instead of all pairs. `near_groups` links whole texts by similarity of word
shingles. Its first candidates are the texts whose fingerprints `components_of` links, each compared with the first text of
its class. 64 bits say too little of pairs further apart: for these, bands of least shingle hashes name candidates, which are
compared with changing heads of their bucket until all are linked or settled. A pair at the similarity of 0.8 shares no band
with probability 3e-6, a closer one with less. Of all candidates, those that the sizes and 1024 parity bits of the sets rule
out for certain go at once; the others are verified by the Jaccard similarity of their whole shingle sets.

Null and empty texts have fingerprint zero and link like any other (`components_of`), or form one group of texts without
words (`near_groups`). Repeated rows are copies. Null keys take no part in a smallest key; a group of null keys only has
null. Empty tables give empty results, extra columns are left alone. Fingerprints never reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import spread_join
from ..session import Scratch, cut
from .common import free, mix64, unsigned, whole
from .components import components

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
GENERATOR = 0xAE3  # fixed value: generator polynomial of the binary Golay code


def _remainder(word: int) -> int:
    for i in range(22, 10, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - 11)
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and high 11 bits of a word, and for each remainder the nearest error pattern and the
    further five patterns of weight four (the same pattern again where there are none)."""
    low = np.array([_remainder(i) for i in range(1 << 12)], np.int32)
    high = np.array([_remainder(i << 12) for i in range(1 << 11)], np.int32)
    bits = [1 << i for i in range(23)]
    leader = np.zeros(2048, np.int32)
    for w in range(4):
        for some in combinations(bits, w):
            leader[_remainder(sum(some))] = sum(some)
    more = np.repeat(leader[:, None], 5, axis=1)
    found = np.zeros(2048, np.int64)
    for info in range(1 << 12):
        code = info << 11 ^ _remainder(info << 11)
        if code.bit_count() == 7:
            for some in combinations([b for b in bits if b & code], 3):
                at = _remainder(sum(some))
                more[at, found[at]] = sum(some) ^ code
                found[at] += 1
    return low, high, leader, more


def golay_keys(fp: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, 18 columns, and which of them are no repetition."""
    low, high, leader, more = tables
    parts = [((fp >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    keys, new = [], []
    for k in range(3):
        exact, near = parts[k], parts[(k + 1) % 3]
        at = low[near & 4095] ^ high[near >> 12]
        errors = np.concatenate([leader[at][:, None], more[at]], axis=1)
        index = (near[:, None] ^ errors) >> 11
        keys.append((np.int64(k) << 40) | (exact[:, None] << 12) | index)
        mask = np.ones(index.shape, bool)
        mask[:, 1:] = (more[at] != leader[at][:, None])
        new.append(mask)
    return np.concatenate(keys, axis=1), np.concatenate(new, axis=1)


def word_lists(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of lower-cased text, piece by piece, so that a very long text never becomes one list."""
    text, at = text.lower(), 0
    while at < len(text):
        end = at + size
        while end < len(text) and not text[end:end + 1].isspace():
            end += 1
        yield text[at:end].split()
        at = end


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles in order, piece by piece; one shingle of all words if there are fewer."""
    kept: list[bytes] = []
    any_shingle = False
    for piece in word_lists(text):
        piece = kept + piece
        if len(piece) >= words:
            any_shingle = True
            rows = zip(*(piece[i:] for i in range(words)))
            yield np.array([xxhash.xxh64_intdigest(x, 42) for x in map(b" ".join, rows)], np.uint64)
        kept = piece[len(piece) - min(words - 1, len(piece)):] if words > 1 else []
    if not any_shingle and kept:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), 42)], np.uint64)


def majority(parts: Iterator[np.ndarray]) -> int:
    """The word whose bits are set in over half of the hashes; zero for none."""
    ones, n = np.zeros(64, np.int64), 0
    for h in parts:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprint(text: Column, words: int = 3) -> Column:
    """64-bit SimHash over word shingles with repeats, as a signed long."""

    @F.arrow_udf("long")
    def udf(texts: pa.Array) -> pa.Array:
        out = [majority(shingle_hashes(x, words)) for x in texts.cast(pa.large_binary()).to_pylist()]
        return pa.array(np.array(out, np.uint64).view(np.int64))

    return udf(text)


def keys_of(fps: Column) -> Column:
    """All Golay keys of an array of fingerprints; the position in the array is part of a key."""
    code = golay_tables()

    @F.arrow_udf("array<long>")
    def udf(column: pa.Array) -> pa.Array:
        flat = unsigned(column.flatten().to_numpy(zero_copy_only=False))
        sizes = np.diff(column.offsets.to_numpy())
        keys, new = golay_keys(flat, code)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys |= (at << 43)[:, None]
        each = np.add.reduceat(np.append(new.sum(1), 0), np.minimum(np.cumsum(sizes) - sizes, len(flat))) if len(flat) else np.zeros(len(sizes), np.int64)
        each = np.where(sizes > 0, each, 0)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)]).astype(np.int32)), pa.array(keys[new]))

    return udf(fps)


def _shared(rows: DataFrame, node: str) -> DataFrame:
    """Rows (key, node) whose key has several nodes. Merged, as sizes after an explode are estimated far too low."""
    several = rows.groupBy("key").agg(F.min(node).alias("lo"), F.max(node).alias("hi")).where("lo <> hi").select("key")
    return rows.join(several.hint("merge"), "key")


def components_of(rows: DataFrame, fp: str = "fp") -> DataFrame:
    """(fp, root) for every fingerprint that another one links to; a link is two or fewer differing bits."""
    own = Scratch(rows.sparkSession)
    keyed = rows.select(F.col(fp).alias("fp")).distinct()
    keyed = keyed.select("fp", F.explode(keys_of(F.array("fp"))).alias("key"))
    near = own.cut(_shared(keyed, "fp").select("fp").distinct())
    steps = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    hubs = near.select("fp", F.explode(steps).alias("step")).select("fp", F.col("fp").bitwiseXOR(F.col("step")).alias("hub"))
    middle = hubs.groupBy("hub").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("hub", "lo")
    links = hubs.join(middle.hint("merge"), "hub").select(F.col("fp").alias("a"), F.col("lo").alias("b"))
    found = components(links).select(F.col("node").alias("fp"), "root")
    own.drop(near)
    return found


def classes(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3) -> DataFrame:
    """(key, fp, component): component is the smallest key whose fingerprint can be reached by links."""
    rows = cut(df.select(F.col(key).alias("key"), fingerprint(whole(text), words).alias("fp")))
    sizes = rows.groupBy("fp").agg(F.min("key").alias("first"))
    linked = sizes.join(components_of(rows), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    linked = cut(linked)
    lowest = linked.groupBy("root").agg(F.min("first").alias("component"))
    return rows.join(linked.join(lowest, "root").select("fp", "component"), "fp").select("key", "fp", "component")


def _word_hashes(text: bytes) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 42) for part in word_lists(text) for w in part], np.uint64)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; of the whole sequence if there are fewer words."""
    h = _word_hashes(text)
    size = min(words, len(h))
    if not size:
        return h
    total = h[:len(h) - size + 1].copy()
    for i in range(1, size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i]
    return np.unique(mix64(total))


BANDS, ROWS = 24, 4  # texts of similarity 0.8 share no band with probability (1 - 0.8**4)**24 = 3e-6
PARITY = 16  # words of parity bits; they tell sets of up to some 1400 shingles apart, larger ones less and less


def band_keys(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Keys of the bands: each the least values of the shingles under some multiplicative hashes."""
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 4096):
        low = np.minimum(low, (factors[:, None] * short[None, i:i + 4096] + shifts[:, None]).min(1))
    key = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + row)
    return key


def parity(shingles: np.ndarray) -> np.ndarray:
    """Bits, each the parity of the shingles that fall to it. A shingle of one set only flips one bit, so two sets differ by
    at least as many shingles as their words by bits."""
    odd = np.bincount((shingles & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sketch(text: Column, words: int) -> Column:
    """struct(n, fp, odd, keys): the number of different shingles, their SimHash and parity words, and the keys of the bands;
    texts without words have one key."""
    rng = np.random.default_rng(17)
    factors = rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)

    @F.arrow_udf("struct<n: int, fp: long, odd: array<long>, keys: array<long>>")
    def udf(texts: pa.Array) -> pa.Array:
        sizes, fps, odd, keys = [], [], [], []
        for x in texts.cast(pa.large_binary()):
            s = shingle_set(x.as_py(), words)
            sizes.append(len(s))
            fps.append(majority(s[i:i + 65536] for i in range(0, len(s), 65536)))
            odd.append(parity(s))
            keys.append(band_keys(s, factors, shifts).view(np.int64) if len(s) else np.zeros(1, np.int64))
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (odd, keys)]
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), pa.array(np.array(fps, np.uint64).view(np.int64)), *lists], ["n", "fp", "odd", "keys"])

    return udf(text)


def _shingles(text: Column, words: int) -> Column:
    @F.arrow_udf("array<long>")
    def udf(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        parts = [pa.array([shingle_set(x.as_py(), words).view(np.int64) for x in texts.slice(i, 256)], pa.list_(pa.int64())) for i in range(0, len(texts), 256)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return udf(text)


def _jaccard_at_least(a: Column, b: Column, similarity: float) -> Column:
    """Whether two sorted sets are alike enough; two empty ones are."""

    @F.arrow_udf("boolean")
    def udf(one: pa.Array, two: pa.Array) -> pa.Array:
        out, left, right = [], one.flatten().to_numpy().view(np.uint64), two.flatten().to_numpy().view(np.uint64)
        p, q = one.offsets.to_numpy() - one.offsets[0].as_py(), two.offsets.to_numpy() - two.offsets[0].as_py()
        for i in range(len(one)):
            x, y = left[p[i]:p[i + 1]], right[q[i]:q[i + 1]]
            at = np.minimum(np.searchsorted(x, y), max(len(x) - 1, 0))
            both = int((x[at] == y).sum()) if len(x) else 0
            out.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
        return pa.array(out, pa.bool_())

    return udf(a, b)


def text_key(text: Column) -> Column:
    """128 bits that identify a text."""
    return F.unhex(F.md5(text.cast("binary")))


def _may_reach(similarity: float) -> Column:
    """Whether texts (n, odd) and (hn, hodd) can be that similar: a set bounds the part in common, and the parity words bound
    the part that isn't from below. No pair that is similar enough is ruled out."""
    apart = sum((F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("hodd")[i])) for i in range(PARITY)), F.lit(0))
    most = F.lit((1 - similarity) / (1 + similarity)) * (F.col("n") + F.col("hn"))
    return (F.least("n", "hn") >= F.lit(similarity) * F.greatest("n", "hn") - 1e-9) & (apart <= most + 1e-6)


def near_texts(df: DataFrame, own: Scratch, text: str = "text", key: str = "doc_id", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(node, key, root) for each different text: node identifies it (128 bits), key is its smallest, root its group.

    Texts whose fingerprints are linked meet the first text of their class. Then texts that share a band key meet in its
    bucket: a round compares one head of each bucket, later more, with the members that are not yet linked to it, each pair
    of texts once. What sizes and parity words leave open is compared by the whole shingle sets. Linked texts become one root, and
    the next round works on roots. Heads leave the bucket, as all their pairs are settled; the others stay, linked or not,
    until all members of a bucket have one root. So every pair of a bucket that is similar enough is linked, if not by itself
    then through others. A bucket's members are spread over tasks by salt, however many they are.

    Tables written on the way belong to `own` and go when they have been read.
    """
    where = df.select(text_key(whole(text)).alias("node"), F.col(key).alias("key"), whole(text).alias("t"))
    rows = own.cut(where.select("key", "node", sketch(F.col("t"), words).alias("s")))
    texts = rows.groupBy("node").agg(F.min("key").alias("key"), F.any_value("s").alias("s"))
    texts = own.cut(texts.select(F.monotonically_increasing_id().alias("id"), "node", "key", "s.*"))
    own.drop(rows)
    alike = own.cut(_alike(texts, similarity, own))
    # a text has a key once, so a key of two rows is shared; only the narrowest rows travel to find this out
    keyed = texts.select("id", F.explode("keys").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1").select("bucket")
    met = own.cut(_spread(keyed, shared, "bucket"))
    ids = met.select("id").unionByName(alike.select(F.explode(F.array("a", "b")).alias("id"))).distinct()
    nodes = own.cut(ids.join(texts.select("id", "node", "key", "n", "odd").hint("merge"), "id"))
    roots = own.cut(nodes.select("id", F.col("id").alias("root")))
    # keys as structs, in which nulls are equal: the join's partitions serve the removal of repeated rows as well
    mine = nodes.select("id", F.col("node").alias("of"), F.struct("key").alias("whose"))
    sets = where.select("node", F.struct("key").alias("k"), "t").join(mine, (F.col("node") == F.col("of")) & (F.col("k") == F.col("whose")))
    sets = sets.dropDuplicates(["node", "k"]).select("id", _shingles(F.col("t"), words).alias("s"))
    sets = own.cut(sets)
    roots, moved = _linked(alike, sets, roots, similarity, own)
    sizes = nodes.select("id", "n", "odd").join(roots.hint("merge"), "id")
    open_rows = own.cut(met.join(sizes.hint("merge"), "id"))
    left = own.cut(_unsettled(_marked(open_rows, moved)))
    own.drop(met, nodes, alike, open_rows, moved)
    open_rows, r = left, 0
    while not open_rows.isEmpty():
        slot = F.pmod(F.xxhash64("id", F.lit(r)), F.lit(8 ** r))
        # linked ones first, then one order for all buckets, so that a pair meets in many buckets through the same head
        rank = F.struct((~F.col("linked")).alias("far"), F.xxhash64("root", F.lit(-1)).alias("h"), "id", "n", "root", "odd")
        heads = open_rows.groupBy("bucket", slot.alias("slot")).agg(F.min(rank).alias("m"))
        heads = own.cut(heads.select("bucket", F.col("m.id").alias("head"), F.col("m.n").alias("hn"), F.col("m.root").alias("hr"), F.col("m.odd").alias("hodd")))
        near = _spread(open_rows, heads, "bucket").where("root <> hr").where(_may_reach(similarity))
        pairs = own.cut(near.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct())
        roots, moved = _linked(pairs, sets, roots, similarity, own)
        done = heads.select("bucket", F.col("head").alias("id"))
        rest = open_rows.drop("root", "linked").join(done.hint("merge"), ["bucket", "id"], "left_anti")
        rest = own.cut(rest.join(roots.hint("merge"), "id"))
        left = own.cut(_unsettled(_marked(rest, moved)))
        own.drop(open_rows, heads, pairs, moved, rest)
        open_rows = left
        r += 1
    own.drop(sets, open_rows)
    return texts.select("id", "node", "key").join(roots.hint("merge"), "id", "left").select("node", "key", F.coalesce("root", "id").alias("root"))


def _alike(texts: DataFrame, similarity: float, own: Scratch) -> DataFrame:
    """Pairs (a, b) of ids: texts whose fingerprints are linked, each with the first of its class, one pair for each text."""
    classed = _spread(texts.select("id", "fp", "n", "odd"), components_of(texts), "fp", "left").withColumn("class", F.coalesce("root", "fp"))
    classed = own.cut(classed.select("id", "n", "odd", "class"))
    first = classed.groupBy("class").agg(F.min("id").alias("head"), F.count("*").alias("_n")).where("_n > 1").select("class", "head")
    first = first.join(classed.select(F.col("id").alias("head"), F.col("n").alias("hn"), F.col("odd").alias("hodd")).hint("merge"), "head")
    return _spread(classed, first, "class").where("id <> head").where(_may_reach(similarity)).select(F.col("head").alias("a"), F.col("id").alias("b"))


def _linked(pairs: DataFrame, sets: DataFrame, roots: DataFrame, similarity: float, own: Scratch) -> tuple[DataFrame, DataFrame]:
    """(roots, moved): roots after the pairs that are similar enough became links, and (root, to) of those that changed."""
    close = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")).hint("merge"), "a")
    close = close.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")).hint("merge"), "b")
    good = own.cut(close.where(_jaccard_at_least(F.col("sa"), F.col("sb"), similarity)).select("a", "b"))
    if good.isEmpty():
        return roots, good.select(F.col("a").alias("root"), F.col("b").alias("to"))
    at = lambda c, name: roots.select(F.col("id").alias(c), F.col("root").alias(name)).hint("merge")
    new = own.cut(good.join(at("a", "ra"), "a").join(at("b", "rb"), "b").select("ra", "rb").distinct())
    moved = own.cut(components(new, "ra", "rb").select(F.col("node").alias("root"), F.col("root").alias("to")))
    after = own.cut(_spread(roots, moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")))
    own.drop(good, new, roots)
    return after, moved


def near_groups(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """(node, key, root) for each row: node identifies the exact text (128 bits), root the group of near duplicates."""
    named = near_texts(df, Scratch(df.sparkSession), text, key, **options).select("node", "root")
    return _spread(df.select(text_key(whole(text)).alias("node"), F.col(key).alias("key")), named, "node", by="key")


def _spread(many: DataFrame, few: DataFrame, on: str, how: str = "inner", by: str = "id") -> DataFrame:
    """Join on a column that may have very many rows of one value on the left side: it runs in several tasks."""
    return spread_join(many, few, [on], how, [by])


def _marked(rest: DataFrame, moved: DataFrame) -> DataFrame:
    """Members whose root has taken others in are heads first."""
    grown = moved.select(F.col("to").alias("root"), F.lit(True).alias("grown")).distinct()
    return _spread(rest, grown, "root", "left").withColumn("linked", F.coalesce("grown", F.lit(False))).drop("grown")


def _unsettled(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several roots."""
    several = rows.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    return _spread(rows, several, "bucket")


def dedup(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest key (nulls last); all columns stay."""
    own = Scratch(df.sparkSession)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "node")).alias("m")
    kept = own.keep(own.cut(near_texts(df, own, text, key, **options).groupBy("root").agg(first).select(F.col("m.node").alias("kept_node"), F.struct("m.key").alias("kept_key"))))
    own.close()
    (node,) = free(df, "node")
    (whose,) = free(df, "whose")
    rows = df.withColumns({node: text_key(whole(text)), whose: F.struct(key)})
    mine = (F.col(node) == F.col("kept_node")) & (F.col(whose) == F.col("kept_key"))
    # the semi join deals rows out by text and key, and repeated rows go without another shuffle
    return rows.join(kept, mine, "left_semi").dropDuplicates([node, whose]).select(*df.columns)
