"""SentencePiece byte-pair encoding by a prefix table over the whole text, and decoding.

Merging always takes the best pair, the leftmost of equals. Two facts follow. The pieces of a text are the pieces of each of
its prefixes that ends between two of them, and a sequence of pieces is what merging gives if and only if every two
neighbours stay apart when merged on their own: the first merge that crosses a border would also be the first to cross it
with only the two pieces next to it. So a prefix has one last piece. An automaton names the pieces that end at a
position; the one that is compatible with the last piece of the prefix before it is the last piece here. When the table is
full, the ids are read off backwards.

Compatibility of two pieces replays both merge histories by their order and looks at what stands at the border in
between. Pieces that merging never builds have no history and are no candidates. Characters of no piece are borders and
become their bytes; a character that occurs in pieces but is none itself is a piece that becomes bytes.

Texts are cut where no piece can cross (before a space after something else, between characters that can share no piece),
a bounded memo keeps short
units, and long texts are taken in slices, so memory does not grow with a text beyond its ids. Nothing is shuffled.

Ids are packed as little-endian unsigned 32-bit integers in a binary column. Null texts count as empty, an empty text has the
begin and end id only. Null ids decode to an empty text, ids outside the vocabulary raise. Other columns pass through; an
output column takes the first free name. Models need byte fallback, the identity normaliser, a space put in front and kept
spaces, and no user-defined or unused pieces; others raise.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import free

SPACE = "▁"  # fixed value: the format writes a space as this character
UNIT = 64  # characters of a unit that the memo keeps
UNITS = 200_000  # units in the memo
PAIRS = 1 << 18  # compatibility results in the memo
SLICE = 1 << 18  # characters taken at once


@dataclass(frozen=True)
class Model:
    """A vocabulary: the piece of each id, its score, and what kind it is (n normal, c control, u unknown, b byte)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str
    begin: int
    end: int


def load(path: str) -> Model:
    """The vocabulary of a SentencePiece model file, as far as this module can express the model."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    n = lib.get_piece_size()
    kinds = "".join("u" if lib.is_unknown(i) else "c" if lib.is_control(i) else "b" if lib.is_byte(i) else "x" if lib.is_unused(i) else "n"
                    for i in range(n))
    probe = "  Ａ ﬁ  é "
    if "x" in kinds or kinds.count("b") != 256 or lib.decode(lib.encode(probe)) != probe or lib.encode("a", out_type=str)[0][0] != SPACE:
        raise ValueError("needs byte fallback, the identity normaliser, a space in front and no unused pieces")
    return Model(tuple(lib.id_to_piece(i) for i in range(n)), tuple(lib.get_score(i) for i in range(n)), kinds, lib.bos_id(), lib.eos_id())


class Merges:
    """Merge histories of pieces, and which neighbours stay apart."""

    def __init__(self, model: Model):
        self.order = {p: -s for p, s, kind in zip(model.pieces, model.scores, model.kinds) if kind == "n"}  # smaller comes first
        self.histories: dict[str, tuple | None] = {}

    def history(self, piece: str) -> tuple | None:
        """(order, symbol at the left edge, symbol at the right edge) after each merge inside the piece, the characters
        first; None if merging the piece's characters does not end with the piece."""
        if piece not in self.histories:
            parts, none = list(piece), float("inf")
            steps = [(none, parts[0], parts[-1])]
            while len(parts) > 1:
                best, at = min((self.order.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if best == none:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                steps.append((best, parts[0], parts[-1]))
            self.histories[piece] = tuple(steps) if len(parts) == 1 else None
        return self.histories[piece]

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the text of two pieces gives the two pieces."""
        a, b, none = self.history(left), self.history(right), float("inf")
        i = j = 0
        while True:
            cross = self.order.get(a[i][2] + b[j][1], none)
            next_a = a[i + 1][0] if i + 1 < len(a) else none
            next_b = b[j + 1][0] if j + 1 < len(b) else none
            if cross < next_a and cross <= next_b:
                return False
            if next_a == none and next_b == none:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class Pairs(dict):
    """Compatibility of two pieces by left * 2**20 + right, remembered."""

    def __init__(self, merges: Merges, names: list[str]):
        super().__init__()
        self.merges, self.names = merges, names

    def __missing__(self, pair: int) -> bool:
        if len(self) >= PAIRS:
            self.clear()
        self[pair] = known = self.merges.apart(self.names[pair >> 20], self.names[pair & 0xFFFFF])
        return known


def unit_pattern(names: list[str]) -> re.Pattern:
    """Runs of characters that can share a piece, after any spaces; no piece crosses the border of two matches.

    Characters next to each other in some piece belong to one class, and so do their neighbours; a character beside none is
    a unit of its own."""
    if any(SPACE in name.lstrip(SPACE) for name in names):
        return re.compile("(?s).+")
    of: dict[str, str] = {}

    def top(c: str) -> str:
        while of.setdefault(c, c) != c:
            of[c] = of[of[c]]
            c = of[c]
        return c

    for name in names:
        for a, b in zip(name, name[1:]):
            if a != SPACE:
                of[top(a)] = top(b)
    classes: dict[str, list[str]] = {}
    for c in sorted(of):
        classes.setdefault(top(c), []).append(c)
    runs = [f"[{re.escape(''.join(cs))}]+" for cs in sorted(classes.values(), key=len, reverse=True)]
    return re.compile(f"(?s){SPACE}*(?:{'|'.join([*runs, f'[^{SPACE}]'])})|{SPACE}+")


class Encoder(dict):
    """The packed ids of units, remembered for short ones."""

    def __init__(self, model: Model):
        super().__init__()
        merges = Merges(model)
        byte_id = {int(model.pieces[i][3:5], 16): i for i, kind in enumerate(model.kinds) if kind == "b"}
        pack = lambda ids: np.array(ids, "<u4").tobytes()
        self.raw = lambda char: pack([byte_id[b] for b in char.encode()])
        built = [i for i, kind in enumerate(model.kinds) if kind == "n" and merges.history(model.pieces[i])]
        self.names = [model.pieces[i] for i in built]
        self.packed = [pack([i]) for i in built]
        for char in sorted(set("".join(self.names)) - set(self.names)):
            self.names.append(char)
            self.packed.append(self.raw(char))
        self.sizes = list(map(len, self.names))
        self.automaton = ahocorasick.Automaton()
        for i, name in enumerate(self.names):
            self.automaton.add_word(name, (i, len(name) - 1))
        self.automaton.make_automaton()
        self.begin, self.end = pack([model.begin]), pack([model.end])
        self.pairs = Pairs(merges, self.names)
        self.units = unit_pattern(self.names)

    def __missing__(self, unit: str) -> bytes:
        packed = self.merged(unit)
        if len(unit) <= UNIT:
            if len(self) >= UNITS:
                self.clear()
            self[unit] = packed
        return packed

    def merged(self, unit: str) -> bytes:
        """Packed ids of a unit through its prefix table."""
        last = [-1] * (len(unit) + 1) if len(unit) < 4096 else array("i", [-1]) * (len(unit) + 1)  # of the empty prefix at the end
        pairs = self.pairs
        for stop, (piece, more) in self.automaton.iter(unit):
            if last[stop] < 0:
                before = last[stop - more - 1]
                if before < 0 or pairs[before << 20 | piece]:
                    last[stop] = piece
        out, at = [], len(unit) - 1
        while at >= 0:
            piece = last[at]
            if piece < 0:
                out.append(self.raw(unit[at]))
                at -= 1
            else:
                out.append(self.packed[piece])
                at -= self.sizes[piece]
        out.reverse()
        return b"".join(out)

    def slices(self, text: str) -> Iterator[str]:
        """The text with written spaces, cut between units."""
        at = 0
        edge = re.compile("(?!)" if self.units.pattern == "(?s).+" else f"(?<=[^ {SPACE}])[ {SPACE}]")
        while at < len(text):
            found = edge.search(text, at + SLICE)
            stop = found.start() if found else len(text)
            yield ("" if at else SPACE) + text[at:stop].replace(" ", SPACE)
            at = stop

    def ids(self, text: str) -> bytes:
        """Packed ids of a text with begin and end."""
        parts = [self.begin]
        for some in self.slices(text):
            parts.append(b"".join(map(self.__getitem__, self.units.findall(some))))
        return b"".join([*parts, self.end])


class Decoder:
    """Texts of packed ids."""

    def __init__(self, model: Model):
        kinds = np.frombuffer(model.kinds.encode(), np.uint8)
        self.silent = kinds == ord("c")
        self.texts = [bytes([int(p[3:5], 16)]) if k == "b" else b"" if k == "c" else " ⁇ ".encode() if k == "u" else p.replace(SPACE, " ").encode()
                      for p, k in zip(model.pieces, model.kinds)]
        self.kinds = model.kinds

    def text(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        spoken = ids[~self.silent[ids]]
        out = b"".join(map(self.texts.__getitem__, spoken.tolist()))
        if len(spoken) and self.kinds[spoken[0]] == "n" and out[:1] == b" ":
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:
            return _patched(out)


def _patched(data: bytes) -> str:
    """Text of bytes, each byte of no character replaced."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[at:at + e.start].decode() + "�" * (e.end - e.start))
            at += e.end
    return "".join(out)


def _mapped(batch: pa.Array, fn, kind: pa.DataType) -> pa.Array:
    """An Arrow array of fn over the values, built from small pieces, so few Python values live at once."""
    parts = [pa.array([fn(x.as_py()) for x in batch.slice(i, 256)], kind) for i in range(0, len(batch), 256)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def ids_of(text: Column, model: Model) -> Column:
    """Packed ids of a text column."""

    @F.arrow_udf("binary")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(model)
        for batch in batches:
            yield _mapped(batch, lambda x: encoder.ids(x or ""), pa.binary())

    return udf(text)


def text_of(ids: Column, model: Model) -> Column:
    """The text of packed ids."""

    @F.arrow_udf("string")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(model)
        for batch in batches:
            yield _mapped(batch, lambda x: decoder.text(x or b""), pa.string())

    return udf(ids)


def there_and_back(text: Column, model: Model) -> Column:
    """struct(ids, decoded): packed ids of a text, and the text that these ids decode to, in one pass over the texts."""

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = Encoder(model), Decoder(model)
        for batch in batches:
            ids = _mapped(batch, lambda x: encoder.ids(x or ""), pa.binary())
            yield pa.StructArray.from_arrays([ids, _mapped(ids, decoder.text, pa.string())], ["ids", "decoded"])

    return udf(text)


def encode(df: DataFrame, model: Model, text: str = "text", out: str = "ids") -> DataFrame:
    """All columns and the packed ids of the text."""
    return df.withColumn(free(df, out)[0], ids_of(F.col(text), model))


def decode(df: DataFrame, model: Model, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the text of the packed ids."""
    return df.withColumn(free(df, out)[0], text_of(F.col(ids), model))


def round_trip(df: DataFrame, model: Model, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns, the packed ids of the text and the text that they decode to."""
    ids, out, both = free(df, ids, out, "both")
    return df.withColumn(both, there_and_back(F.col(text), model)).withColumns({ids: F.col(both)["ids"], out: F.col(both)["decoded"]}).drop(both)
