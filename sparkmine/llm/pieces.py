"""Sub-word pieces of a SentencePiece BPE model, with the byte span of the original text behind each.

A text is first normalised: at each place the longest prefix that the model's compiled character map
knows is replaced, any other sign is kept, blanks are handled as the model says. Every byte of the
normalised text remembers the byte of the original at which its prefix began. The normalised text
is then cut before blanks, wherever no piece of the model reaches across one, and around ASCII signs
that no longer piece holds (a line's end); each different part of a batch is merged pair by pair, best score first. Signs without a piece become byte pieces. Lengths of the pieces,
read through the remembered places, are spans of original bytes.

The character map is a double-array trie followed by its replacements; it is walked as stored in the
model file. Parts are remembered up to a bound within one task and forgotten at its end.

Defined results: null is the empty text; an empty text has no piece besides the marks asked for; of the bytes of a
sign without a piece the last has the sign's span, the others are empty spans at its start, as a
mark's span is at its place; rows that repeat an id each get a row; empty tables give no rows. Models other
than BPE with byte fallback, or with pieces defined by a user, are refused.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import re
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
REMEMBERED = 200_000  # parts of a generation; a task keeps two
SHORT = 32  # signs of a part up to which it is merged together with others
ROWS = 2_000  # parts that are merged together
SIGNS_AT_ONCE = 500_000  # signs of the texts that are encoded together (one text more may follow)

# Fixed values of the model format: kinds of pieces and the numbers of the fields that are read.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def fields(data: bytes):
    """(number, value) of a protocol buffer message: whole numbers, bytes, or the bits of a float."""
    at, end = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class CharacterMap:
    """Longest-prefix replacement by a compiled map; without one, every sign stands for itself."""

    units: tuple[int, ...] = ()
    replacements: bytes = b""

    @staticmethod
    def compiled(blob: bytes) -> CharacterMap:
        if len(blob) <= 4:
            return CharacterMap()
        size = struct.unpack_from("<I", blob)[0]
        return CharacterMap(struct.unpack_from(f"<{size // 4}I", blob, 4), blob[4 + size :])

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``text`` from ``at`` on."""
        node, units, found = 0, self.units, None
        node ^= _offset(units[0])
        for i in range(at, len(text)):
            b = text[i]
            node ^= b
            unit = units[node]
            if unit & 0x800000FF != b:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start : self.replacements.index(0, start)]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 512) >> 6)


@dataclass
class Model:
    """What encoding and decoding need of a model file."""

    names: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    chars: CharacterMap = field(default_factory=CharacterMap)
    dummy_prefix: bool = True
    squeeze: bool = True  # outer and repeated blanks go
    escape: bool = True  # a blank is written as BLANK
    suffix: bool = False  # the dummy blank stands behind the text
    begin: int = 1
    end: int = 2

    @staticmethod
    def read(data: bytes) -> Model:
        m, kind, fallback = Model(), 1, False
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                m.names.append(piece.get(1, b"").decode())
                m.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                m.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                spec = dict(fields(value))
                kind, fallback, m.suffix = spec.get(3, 1), bool(spec.get(35, 0)), bool(spec.get(24, 0))
                m.begin, m.end = _signed(spec.get(41, 1)), _signed(spec.get(42, 2))
            elif number == 3:
                spec = dict(fields(value))
                m.chars = CharacterMap.compiled(spec.get(2, b""))
                m.dummy_prefix, m.squeeze, m.escape = (bool(spec.get(i, 1)) for i in (3, 4, 5))
        if kind != BPE or not fallback or {USER_DEFINED, UNUSED} & set(m.kinds):
            raise ValueError("only BPE models with byte fallback and without pieces of a user are read")
        return m


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@dataclass
class Normalised:
    text: str
    places: np.ndarray | None  # original byte for each byte of ``text`` and its end; None: computed when asked for


def normalise(model: Model, text: str) -> Normalised:
    """The normalised text and where its bytes come from."""
    if not model.chars.units and not model.squeeze and model.escape and not model.suffix:
        if not text:
            return Normalised("", np.zeros(1, np.int64))
        return Normalised((BLANK if model.dummy_prefix else "") + text.replace(" ", BLANK), None)
    data = text.encode()
    out, places, at, size = bytearray(), [], 0, len(data)

    def step():
        known = model.chars.longest(data, at) if model.chars.units else None
        if known:
            return known
        lead = data[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, data[at : at + n]

    def put(piece: bytes):
        for b in piece:
            signs = BLANK.encode() if model.escape and b == 32 else bytes((b,))
            out.extend(signs)
            places.extend([at] * len(signs))

    if model.squeeze:
        while at < size:
            n, piece = step()
            if piece != b" ":
                break
            at += n
    if at == size:
        return Normalised("", np.array([at], np.int64))
    if model.dummy_prefix and not model.suffix:
        put(b" ")
    after_blank = model.squeeze
    while at < size:
        n, piece = step()
        if after_blank:
            piece = piece.lstrip(b" ")
        if piece:
            put(piece)
        if model.squeeze and piece:
            after_blank = piece.endswith(b" ")
        at += n
    end = at
    if model.squeeze:
        blank = BLANK.encode() if model.escape else b" "
        while out.endswith(blank):
            end = places[-len(blank)]
            del out[-len(blank) :], places[-len(blank) :]
    if model.dummy_prefix and model.suffix:
        at = end
        put(b" ")
    return Normalised(out.decode("utf-8", "replace"), np.array([*places, end], np.int64))


def original_places(model: Model, text: str, of: Normalised) -> np.ndarray:
    """The original byte of each byte of the normalised text, with its end."""
    if of.places is not None:
        return of.places
    # only blanks changed: three bytes for one; a sign's bytes all come from where it begins
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0))
    own = np.repeat(starts, np.where(data == 32, 3, 1))
    return np.concatenate([np.zeros(3 if model.dummy_prefix else 0, np.int64), own, [len(data)]])


class Encoder:
    """Encodes texts with one model; ``parts`` remembers the pieces of the last parts.

    Parts of up to ``SHORT`` signs that are not remembered are merged together: a matrix has the signs of a part in a
    row, and each round joins the best pair of every row. A sign that is no piece is the number of pieces plus its code point.
    """

    def __init__(self, model: Model):
        self.model = model
        usable = {n: i for i, (n, k) in enumerate(zip(model.names, model.kinds, strict=True)) if k == NORMAL}
        self.ids = usable
        self.scores = {n: model.scores[i] for n, i in usable.items()}
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(model.names, model.kinds, strict=True)) if k == BYTE}
        sizes = np.array([len(n.encode()) for n in model.names], np.int64)
        self.lead = np.zeros(len(sizes), np.int8)  # bytes of the sign that a byte piece begins, if more than one
        for b, i in self.bytes.items():
            sizes[i], self.lead[i] = b < 0x80, 0 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        self.sizes = sizes  # bytes that a piece spans; the last of a sign's byte pieces spans all of it
        across = any(BLANK in n.lstrip(BLANK) for n in usable)
        # a part: blanks and what follows them up to the next blank or sign of its own; all at once if a piece reaches across
        self.whole = across or not model.escape
        self.lone = np.zeros(256, bool)
        self.lone[:128] = True
        self.lone[[ord(c) for n in usable if len(n) > 1 for c in n if c < "\x80"]] = False
        self.forget()
        self.sign = np.arange(0x110000, dtype=np.int32) + len(model.names)
        for n, i in usable.items():
            if len(n) == 1:
                self.sign[ord(n)] = i
        pairs = {}
        for n, i in usable.items():
            for cut in range(1, len(n)):
                a, b = self._number(n[:cut]), self._number(n[cut:])
                if a is not None and b is not None:
                    pairs[a << 21 | b] = i
        self.pairs = pd.Index(np.fromiter(pairs, np.int64, len(pairs)))
        self.joined = np.append(np.fromiter(pairs.values(), np.int64, len(pairs)), -1)
        self.pair_scores = np.append(np.array(model.scores)[self.joined[:-1]], -np.inf)  # the last is for pairs that are no piece

    def _number(self, signs: str) -> int | None:
        return self.ids.get(signs) if len(signs) > 1 else int(self.sign[ord(signs)])

    def merged(self, part: str) -> list[str]:
        """Pieces of a part: neighbours are joined, the best score first, of equals the leftmost."""
        signs = list(part)
        scores, n = self.scores, len(signs)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(i, j):
            if 0 <= i and j < n:
                whole = signs[i] + signs[j]
                score = scores.get(whole)
                if score is not None:
                    heapq.heappush(queue, (-score, i, j, whole))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, whole = heapq.heappop(queue)
            if after[i] != j or not signs[i] or signs[i] + signs[j] != whole:
                continue
            signs[i], signs[j] = whole, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in signs if s]

    def _looked_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where each pair stands among the pairs that are pieces; -1 for others, and beside an empty place (-1)."""
        key = np.where((a < 0) | (b < 0), -1, a << 21 | b)
        return self.pairs.get_indexer(key.ravel()).reshape(key.shape)

    def merged_rows(self, signs: np.ndarray) -> np.ndarray:
        """The pieces of each row of a matrix of signs; rows are filled up with -1."""
        out, rows = signs.copy(), np.arange(len(signs))
        place = np.arange(signs.shape[1])
        pair = self._looked_up(signs[:, :-1], signs[:, 1:])
        while len(rows) and signs.shape[1] > 1:
            score = self.pair_scores[pair]
            best = score.argmax(axis=1)  # the leftmost of the best
            own = np.arange(len(rows))
            done = np.isneginf(score[own, best])
            if done.any():
                out[rows[done]] = signs[done]
                rows, signs, pair, best = rows[~done], signs[~done], pair[~done], best[~done]
                own = np.arange(len(rows))
                if not len(rows):
                    break
            piece = self.joined[pair[own, best]]
            behind = place[None, :] > best[:, None]
            moved = np.concatenate([signs[:, 1:], np.full((len(rows), 1), -1)], axis=1)
            signs = np.where(behind, moved, signs)
            signs[own, best] = piece
            moved = np.concatenate([pair[:, 1:], np.full((len(rows), 1), -1)], axis=1)
            pair = np.where(behind[:, :-1], moved, pair)
            left = np.maximum(best - 1, 0)
            pair[own, left] = np.where(best > 0, self._looked_up(signs[own, left], piece), pair[own, left])
            right = np.minimum(best + 1, signs.shape[1] - 1)
            at = np.minimum(best, pair.shape[1] - 1)
            last = best == pair.shape[1]
            pair[own, at] = np.where(last, pair[own, at], self._looked_up(piece, np.where(best + 1 > right, -1, signs[own, right])))
        else:
            out[rows] = signs
        return out

    def _told(self, numbers: list[int]) -> bytes:
        """Ids of the pieces as 32-bit numbers; a sign without a piece has one for each of its bytes."""
        n = len(self.sizes)
        return np.array([i for x in numbers for i in ((x,) if x < n else map(self.bytes.__getitem__, chr(x - n).encode()))], np.int32).tobytes()

    def forget(self) -> None:
        # 32-bit numbers as bytes, since lists by the hundred thousand would slow the garbage collector; and the generation before
        self.parts: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def remember(self, parts: list[str]) -> None:
        """Put the pieces of all these different parts into ``parts``; when that is full, it becomes the old one."""
        if len(self.parts) + len(parts) > REMEMBERED:
            self.old, self.parts = self.parts, {}
        known, new = self.parts, []
        for p in parts:
            if p not in known:
                again = self.old.get(p)
                if again is None:
                    new.append(p)
                else:
                    known[p] = again
        new.sort(key=len)
        short = bisect.bisect_right(new, SHORT, key=len)
        for at in range(0, short, ROWS):  # of nearly equal lengths
            rows = new[at : min(at + ROWS, short)]
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            numbers = self.sign[np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)]
            signs = np.full((len(rows), int(sizes[-1])), -1, np.int64)
            signs[np.arange(signs.shape[1])[None, :] < sizes[:, None]] = numbers
            found = self.merged_rows(signs)
            width = 4 * found.shape[1]
            ids = found.astype(np.int32).tobytes()
            starts = np.arange(0, width * len(rows), width)
            cuts = zip(starts.tolist(), (starts + 4 * (found >= 0).sum(axis=1)).tolist(), strict=True)
            known.update(zip(rows, [ids[x:y] for x, y in cuts], strict=True))
            for r in np.flatnonzero(found.max(axis=1) >= len(self.sizes)).tolist():
                known[rows[r]] = self._told([i for i in found[r].tolist() if i >= 0])
        for p in new[short:]:
            known[p] = self._told([i for x in self.merged(p) if (i := self._number(x)) is not None])

    def _cuts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where the parts of normalised texts, laid end to end, begin, and the end; ``begins`` are the texts' own."""
        cut = np.zeros(len(data) + 1, bool)
        cut[begins] = cut[-1] = True
        if not self.whole:
            a, b, c = BLANK.encode()
            blank = np.zeros(len(data) + 1, bool)
            blank[:-3] = (data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)
            cut |= blank & ~np.concatenate([np.zeros(3, bool), blank[:-3]])
            lone = self.lone[data]
            cut[:-1] |= lone
            cut[1:] |= lone
        return np.flatnonzero(cut)

    def encode_all(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """For each text the ids of its pieces and the original bytes at which each begins and ends."""
        norms = [normalise(self.model, t) for t in texts]
        own = [n.text.encode() for n in norms]
        data = b"".join(own)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
        cuts = self._cuts(np.frombuffer(data, np.uint8), begins) if data else np.zeros(1, np.int64)
        parts = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        every = parts.dictionary.to_pylist()
        self.remember(every)
        told = list(map(self.parts.__getitem__, every))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in told])]).astype(np.int64)
        flat, at = _taken(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(told), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(told))]), parts.indices)
        found = np.frombuffer(flat, np.int32)
        size = self.sizes[found]
        leads = np.flatnonzero(self.lead[found])
        width = self.lead[found[leads]].astype(np.int64)
        size[leads + width - 1] = width
        end = np.cumsum(size)
        ids, starts, ends = [], [], []
        of = at[np.searchsorted(cuts, begins)] // 4
        for t, norm, base, lo, hi in zip(texts, norms, begins.tolist(), of.tolist(), of[1:].tolist(), strict=False):
            ids.append(found[lo:hi])
            last = end[lo:hi] - base
            places = original_places(self.model, t, norm)
            starts.append(places[last - size[lo:hi]])
            ends.append(places[last])
        return ids, starts, ends

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        ids, starts, ends = self.encode_all([text])
        return ids[0].tolist(), starts[0], ends[0]


class Decoder:
    """Turns ids into text."""

    def __init__(self, model: Model):
        self.model = model
        self.surface = [
            b"" if k == CONTROL else bytes([int(n[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else n.replace(BLANK, " ").encode()
            for n, k in zip(model.names, model.kinds, strict=True)
        ]
        self.is_byte = [k == BYTE for k in model.kinds]
        self.marks = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.mark = np.array([k == CONTROL for k in model.kinds], np.int64)
        self.shown = pa.array(self.surface, pa.large_binary())

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: marks are left out, the dummy blank goes, bytes that are no text become U+FFFD."""
        first = next((i for i in ids if i not in self.marks), None)
        data = b"".join(map(self.surface.__getitem__, ids))
        try:
            text = data.decode()
            if not self.marks.isdisjoint(ids[:-1]):  # bytes on both sides of a mark are no sign
                text = self._mended(ids)
        except UnicodeDecodeError:
            text = self._mended(ids)
        return self._bare(text, first)

    def decode_all(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        """``decode`` of ``ids[cuts[k] : cuts[k + 1]]`` for each k, in one pass over them."""
        data, at = _taken(self.shown, pa.array(ids))
        at, marks = at[cuts].tolist(), np.concatenate([[0], np.cumsum(self.mark[ids])])
        out = []
        for lo, hi, a, z in zip(cuts.tolist(), cuts[1:].tolist(), at, at[1:], strict=False):
            text = None
            if hi - lo > 1 and marks[lo] == marks[hi - 1]:  # marks are at the end only, if anywhere
                try:
                    text = self._bare(str(data[a:z], "utf-8"), int(ids[lo]))
                except UnicodeDecodeError:
                    pass
            out.append(self.decode(ids[lo:hi].tolist()) if text is None else text)
        return out

    def _bare(self, text: str, first: int | None) -> str:
        """``text`` without the dummy blank, ``first`` being its first piece."""
        blank = not self.model.suffix and first is not None and not self.is_byte[first] and self.model.names[first].startswith(BLANK)
        if blank and self.model.squeeze:
            return text.lstrip(" ")
        return text[1:] if blank and self.model.dummy_prefix else text

    def _mended(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            while run:
                n = next((n for n in (4, 3, 2, 1) if len(run) >= n and _one_sign(run[:n])), 0)
                out.append(run[:n].decode() if n else "�")
                run = run[max(n, 1) :]
            if i is not None:
                out.append(self.surface[i].decode())
        return "".join(out)


def _one_sign(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def _taken(values: pa.Array, at: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of ``values`` at the places ``at``, end to end, and where each begins, with the end."""
    got = values.take(at)
    cuts = np.frombuffer(got.buffers()[1], np.int64)[got.offset : got.offset + len(got) + 1] if len(got) else np.zeros(1, np.int64)
    return memoryview(got.buffers()[2] or b"")[int(cuts[0]) : int(cuts[-1])], cuts - cuts[0]


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _lists(parts: list, kind=np.int32) -> pa.Array:
    """An Arrow list for each of ``parts``."""
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([np.asarray(p, kind) for p in parts]) if parts else np.empty(0, kind)))


def _slices(b: pa.RecordBatch, column: int):
    """The batch in parts of some ``SIGNS_AT_ONCE`` signs of a column of texts, or of numbers of a column of lists."""
    sizes = pc.fill_null((pc.utf8_length if pa.types.is_string(b.schema.types[column]) else pc.list_value_length)(b.column(column)), 0).to_pylist()
    at = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= SIGNS_AT_ONCE:
            yield b.slice(at, i + 1 - at)
            at, held = i + 1, 0
    if at < b.num_rows:
        yield b.slice(at)


def encoded(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", begin: bool = False, end: bool = True) -> DataFrame:
    """(id, ids array<int>, starts array<int>, ends array<int>): pieces of every text with their spans in its UTF-8 bytes.

    ``begin`` and ``end`` ask for the model's marks around them.
    """

    def pieces(batches):
        encoder = _encoder(model_file)
        m = encoder.model
        mark = lambda at: np.array([at], np.int32)
        try:
            for b in batches:
                for part in _slices(b, 1):
                    texts = _texts(part.column(1))
                    ids, starts, ends = encoder.encode_all(texts)
                    if begin:
                        ids = [np.append(mark(m.begin), x) for x in ids]
                        starts, ends = ([np.append(mark(0), x) for x in xs] for xs in (starts, ends))
                    if end:
                        ids = [np.append(x, mark(m.end)) for x in ids]
                        last = [len(t.encode()) for t in texts]
                        starts, ends = ([np.append(x, n) for x, n in zip(xs, last, strict=True)] for xs in (starts, ends))
                    yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids), _lists(starts), _lists(ends)], ("id", "ids", "starts", "ends"))
        finally:
            encoder.forget()

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(pieces, f"id {kind}, ids array<int>, starts array<int>, ends array<int>").withColumnRenamed("id", id_col)


def digests(pieces: DataFrame, model_file: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, bytes_spanned) of the rows of ``encoded``, whose ids are decoded again."""

    def summed(batches):
        model = _model(model_file)
        decoder = Decoder(model)
        decimal = pa.array([b"%d " % i for i in range(len(model.names))], pa.large_binary())
        for b in batches:
            for part in _slices(b, 1):
                starts, ends = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(part.column(1)).to_numpy())])
                flat = part.column(1).flatten()
                numbers, at = _taken(decimal, flat)
                at = at[cuts].tolist()
                spanned = np.concatenate([[0], np.cumsum(ends.astype(np.int64) - starts)])[cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(cuts), pa.int64()),
                        pa.array([hashlib.sha256(numbers[a : max(a, z - 1)]).hexdigest() for a, z in zip(at, at[1:], strict=False)], pa.string()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoder.decode_all(flat.to_numpy(), cuts)], pa.string()),
                        pa.array(np.diff(spanned), pa.int64()),
                    ],
                    ("id", "n_tokens", "ids_sha256", "decoded_sha256", "bytes_spanned"),
                )

    kind = pieces.schema[id_col].dataType.simpleString()
    return pieces.select(F.col(id_col).alias("id"), "ids", "starts", "ends").mapInArrow(
        summed, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, bytes_spanned long"
    ).withColumnRenamed("id", id_col)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(_model(path))


@lru_cache(maxsize=1)
def _model(path: str) -> Model:
    with open(path, "rb") as f:
        return Model.read(f.read())
