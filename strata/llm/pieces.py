"""Encoding and decoding with a merge-type SentencePiece vocabulary.

A text's symbols begin as single characters.  An *agenda* holds the adjacent
pairs that are a piece, ordered by the score of that piece and then by place.
The best pair is merged, and the pairs it forms with its two neighbours enter
the agenda, until none is left.  Symbols that are no piece become byte pieces
(or the unknown piece, where the vocabulary has no bytes).

No symbol ever reaches over two characters that stand side by side in no piece
of the vocabulary, so a text may be cut there, and each stretch between cuts is
encoded by itself, with the same result as the whole.  Texts are cut before a
blank that follows something else, and between letters and what is neither
letter nor blank, each if no piece has such a pair; stretches of more than
``SHORT`` characters are cut at all such places.  The agendas of
short stretches are the rows of one matrix, from which each round takes every
row's best pair; a longer stretch has a heap.

Texts are encoded ``SLICE`` characters at a time (one text at least), and a
worker remembers the ids of the short stretches used last, twice ``REMEMBERED``
at most, so memory is bounded by these and the longest text.  The model's bytes
are read on the driver and sent with the function (about half a MB), so workers
need no file.  The library gives the vocabulary and the normaliser, and is what
ids are checked against, within each Arrow batch: ``encode(check=True)`` encodes
every text a second time and says whether it ``agrees``; ``round_trip`` compares
each stretch when a worker first meets it, and a difference fails the job.

Defined results: a null text is read as empty; an empty text has no ids and
decodes to the empty text; rows are independent, so ids may be null or repeated;
an empty table gives an empty result; other columns are carried (those named
like a result are replaced).
"""

from __future__ import annotations

import re
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = "\u2581"        # how the vocabulary writes a space
SHORT = 64              # characters of a stretch whose agenda is a row
SLICE = 1 << 21         # characters encoded at a time
REMEMBERED = 1 << 18    # stretches
ROWS = 1 << 13          # agendas in a matrix
NONE = np.int32(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Codec:
    """Vocabulary, encoder and decoder of one model."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        if any(map(sp.is_unused, ids)):
            raise ValueError("vocabularies with unused pieces are not supported")
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        score = {p: sp.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        place = {x: k for k, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.order = {p: place[x] for p, x in score.items()}    # equal scores share one
        self.unknown = sp.unk_id()
        self.byte_of = {i: int(sp.id_to_piece(i)[1:-1], 16) for i in ids if sp.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.beside = {p[k:k + 2] for p in score for k in range(len(p) - 1)}
        self.stretches = re.compile(self._cuts()).findall
        self._pairs()
        self.text_of = [sp.id_to_piece(i).replace(BLANK, " ") for i in ids]
        for i in ids:
            if sp.is_control(i):
                self.text_of[i] = ""
            elif sp.is_unknown(i):
                self.text_of[i] = sp.decode([i])
        self.digits = [str(i) for i in ids]
        self.bare = {i for i in ids if sp.is_control(i)}
        self.prefixed = sp.normalize("a") != "a"
        in_pieces = {x for p in self.beside for x in p}
        self.lone = next(x for x in map(chr, range(10, 0x10000)) if x not in in_pieces and sp.normalize("a" + x)[-1:] == x)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _cuts(self) -> str:
        """A pattern of the stretches that no piece reaches over."""
        letters = r"[^\W\d_%s]"

        def kind(x, letter):
            return "blank" if x == BLANK else "letter" if re.match(letter, x) else "other"
        # a letter that some piece has before something else counts as something else
        odd = {p[0] for p in self.beside if [kind(x, letters % "") for x in p] == ["letter", "other"]}
        odd = "".join(map(re.escape, sorted(odd)))
        letter, other = letters % odd, f"(?:[\\d_{odd}]|[^\\w{BLANK}])"
        pairs = {(kind(p[0], letter), kind(p[1], letter)) for p in self.beside}
        if pairs & {("letter", "blank"), ("other", "blank")}:
            return "(?s:.+)"
        if ("letter", "other") in pairs:
            return f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+"
        if ("other", "letter") in pairs:
            return f"{BLANK}+{other}*{letter}*|{other}+{letter}*|{letter}+"
        return f"{BLANK}*{letter}+|{BLANK}+{other}*|{other}+"

    def _pairs(self) -> None:
        """Numbers of the symbols (0: none), and a hash table of every two that
        make a piece, with its order and number."""
        self.names = names = ["", *sorted(self.ids.keys() | {x for p in self.order for x in p})]
        self.number = {x: k for k, x in enumerate(names)}
        self.id_of = np.array([self.ids.get(x, -1) for x in names], np.int32)
        self.number_of = np.full(0x110000, len(names), np.int32)    # by code point
        for x, k in self.number.items():
            if len(x) == 1:
                self.number_of[ord(x)] = k
        made = [(self.number[p[:k]] << 32 | self.number[p[k:]], o, self.number[p])
                for p, o in self.order.items() for k in range(1, len(p))
                if p[:k] in self.number and p[k:] in self.number]
        pair, order, number = np.array(made, np.int64).reshape(-1, 3).T
        bits = max(4, (4 * len(pair)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        at, rest = self._slot(pair), np.arange(len(pair))
        while len(rest):                    # who finds its slot taken tries the next one
            free = rest[self.slots[at[rest]] == -1]
            self.slots[at[free]] = pair[free]
            rest = rest[self.slots[at[rest]] != pair[rest]]
            at[rest] = (at[rest] + 1) % len(self.slots)
        self.slot_order = np.full(len(self.slots), NONE, np.int32)
        self.slot_made = np.zeros(len(self.slots), np.int32)
        self.slot_order[at], self.slot_made[at] = order, number

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.view(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def _best(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order and number of the piece that two symbols make (order NONE if none)."""
        pair = a.astype(np.int64) << 32 | b
        at = self._slot(pair)
        there = self.slots[at]
        rest = np.flatnonzero((there != pair) & (there >= 0))
        while len(rest):                    # another pair's slot: the next one
            at[rest] = look = (at[rest] + 1) % len(self.slots)
            there[rest] = own = self.slots[look]
            rest = rest[(own != pair[rest]) & (own >= 0)]
        return np.where(there == pair, self.slot_order[at], NONE), self.slot_made[at]

    # ---- encoding

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str], check: bool = False) -> list[list[int]]:
        """Ids of some texts; what they share is encoded once.  With ``check``
        the library has to give the same ids for each new stretch."""
        cut = [self.stretches(self.library.normalize(t)) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new = set(chain.from_iterable(cut)).difference(self.known)
        again = {s: self.older[s] for s in new if s in self.older}
        self.known.update(again)
        new.difference_update(again)
        short = [s for s in new if len(s) <= SHORT]
        self.known.update(zip(short, self._rows(short)))
        for s in new.difference(short):
            self.known[s] = tuple(chain.from_iterable(map(self._heap, self._parts(s))))
        if check:
            self._compare(list(new))
        out = [list(chain.from_iterable(map(self.known.__getitem__, c))) for c in cut]
        for s in new.difference(short):
            del self.known[s]
        return out

    def _compare(self, new: list[str]) -> None:
        """The library puts a blank before each text.  A stretch that begins
        otherwise follows a character that is in no piece."""
        before = len(self.library.encode(self.lone))
        theirs = self.library.encode([s[1:].replace(BLANK, " ") if s[0] == BLANK and self.prefixed else self.lone + s for s in new])
        for s, ids in zip(new, theirs):
            if self.known[s] != tuple(ids[0 if s[0] == BLANK and self.prefixed else before:]):
                raise ValueError(f"the library encodes {s!r} to {ids}, not {self.known[s]}")

    def _parts(self, s: str) -> list[str]:
        """A stretch cut wherever two characters are in no piece side by side."""
        at = [0, *[k for k, p in enumerate(map(str.__add__, s, s[1:]), 1) if p not in self.beside], len(s)]
        return [s[a:b] for a, b in zip(at, at[1:])]

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        out = []
        for x in symbols:
            if x in self.ids:
                out.append(self.ids[x])
            else:
                raw = [self.id_of_byte.get(b) for b in x.encode()]
                out += [self.unknown] if None in raw else raw
        return tuple(out)

    def _rows(self, stretches: list[str]) -> list[tuple[int, ...]]:
        """Ids of short stretches, those of like length in one matrix."""
        out: list = [None] * len(stretches)
        by_size = np.argsort([len(s) for s in stretches], kind="stable").tolist()
        for k in range(0, len(by_size), ROWS):
            own = by_size[k:k + ROWS]
            for r, ids in zip(own, self._matrix([stretches[r] for r in own])):
                out[r] = ids
        return out

    def _matrix(self, stretches: list[str]) -> list[tuple[int, ...]]:
        """Ids of stretches, each with its agenda in a row: the order of the
        pair that begins at each place.  A symbol 0 stands at a row's both
        ends; merged symbols point over the places they have taken."""
        size = np.array([len(s) for s in stretches])
        wide = int(size.max()) + 2
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbols = np.zeros((len(stretches), wide), np.int32)
        place = np.arange(wide)
        symbols[(place > 0) & (place <= size[:, None])] = self.number_of[codes]
        agenda = np.full(symbols.shape, NONE)
        order, made = self._best(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        agenda[:, :-1] = order.reshape(-1, wide - 1)
        piece = np.zeros(symbols.shape, np.int32)
        piece[:, :-1] = made.reshape(-1, wide - 1)
        rows, symbols, piece = agenda, symbols.ravel(), piece.ravel()
        agenda, right = agenda.ravel(), np.arange(1, symbols.size + 1)
        left = right - 2
        begin = np.arange(0, symbols.size, wide)
        while len(begin):
            at = begin + rows.argmin(1)     # best score, then first place
            live = agenda[at] != NONE
            if not live.all():
                begin, at = begin[live], at[live]
            r = right[at]
            symbols[at], symbols[r] = new, _ = piece[at], 0
            agenda[r] = NONE
            right[at] = r = right[r]
            left[r] = at
            agenda[at], piece[at] = self._best(new, symbols[r])
            b = left[at]
            agenda[b], piece[b] = self._best(symbols[b], new)
            rows = agenda.reshape(-1, wide)[begin // wide]
        symbols = symbols.reshape(-1, wide)
        other = len(self.names)             # any character of no piece
        ids = self.id_of[np.minimum(symbols, other - 1)]
        odd = ((symbols == other) | (ids < 0) & (symbols > 0)).any(1).tolist()
        there = symbols > 0
        ids = ids[there].tolist()
        upto = np.concatenate([[0], np.cumsum(there.sum(1))]).tolist()
        return [self._ids([s[k - 1] if x == other else self.names[x]
                           for k, x in enumerate(symbols[i].tolist()) if x]) if odd[i] else tuple(ids[a:b])
                for i, (s, a, b) in enumerate(zip(stretches, upto, upto[1:]))]

    def _heap(self, s: str) -> tuple[int, ...]:
        """Ids of a stretch of any length, by a heap of pairs; a pair whose
        symbols have changed since it was entered is skipped."""
        n, order = len(s), self.order
        symbols, left, right = list(s), list(range(-1, n)), list(range(1, n + 1))
        agenda = [(order[p], k, p) for k, p in enumerate(map(str.__add__, s, s[1:])) if p in order]
        heapify(agenda)
        while agenda:
            _, k, piece = heappop(agenda)
            r = right[k]
            if r >= n or not symbols[k] or symbols[k] + symbols[r] != piece:
                continue
            symbols[k], symbols[r] = piece, ""
            right[k] = r = right[r]
            left[r] = k
            if r < n and (p := piece + symbols[r]) in order:
                heappush(agenda, (order[p], k, p))
            if (b := left[k]) >= 0 and (p := symbols[b] + piece) in order:
                heappush(agenda, (order[p], b, p))
        return self._ids(list(filter(None, symbols)))

    # ---- decoding

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces in a row, bytes put together to characters (a
        byte that is part of none gives U+FFFD), less the blank that encoding
        puts before a text."""
        bytes_in = not self.byte_of.keys().isdisjoint(ids)
        if not bytes_in:
            text = "".join(map(self.text_of.__getitem__, ids))
        else:
            parts, raw = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    parts.append(characters(bytes(raw)))
                    raw.clear()
                parts.append(self.text_of[i])
            text = "".join(parts) + characters(bytes(raw))
        first = next((i for i in ids if i not in self.bare), None)
        own = first is not None and first not in self.byte_of and first != self.unknown
        return text[1:] if self.prefixed and own and text.startswith(" ") else text


def characters(raw: bytes) -> str:
    """UTF-8 bytes as text, each byte that belongs to no character as U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[:e.start].decode() + "�" + characters(raw[e.start + 1:])


_codecs: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """The worker's codec of a model, made once."""
    if model not in _codecs:
        _codecs.clear()
        _codecs[model] = Codec(model)
    return _codecs[model]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _extended(docs: DataFrame, per_batch, source: str, results: list[T.StructField]) -> DataFrame:
    """``docs`` with columns that ``per_batch`` makes of the ``source`` column."""
    names = {f.name for f in results}
    kept = [f for f in docs.schema.fields if f.name not in names]
    # the source travels beside the carried columns: it may be replaced itself
    slim = docs.select(*[F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(kept)],
                       F.col(f"`{source}`").alias("source"))

    def run(batches):
        for b in batches:
            made = per_batch(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + made, [f.name for f in kept + results])
    return slim.mapInArrow(run, T.StructType(kept + results))


def _sliced(column):
    """The texts of a column, some at a time (null: empty)."""
    part, size = [], 0
    for t in column:
        t = t.as_py() or ""
        part.append(t)
        size += len(t)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, model: str, text: str = "text", check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) of each text; with ``check`` also
    ``agrees``: whether the library gives the same ids.  ``model`` is a path."""
    raw = model_bytes(model)

    def per_batch(texts):
        c, ids, agrees = codec(raw), [], []
        for part in _sliced(texts):
            ids += (own := c.encode_all(part))
            if check:
                agrees += [c.library.encode(t) == x for t, x in zip(part, own)]
        return [pa.array(ids, pa.list_(pa.int32()))] + ([pa.array(agrees, pa.bool_())] if check else [])
    results = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return _extended(docs, per_batch, text, results + [T.StructField("agrees", T.BooleanType())] * check)


def decode(docs: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of each row's ids (null: none)."""
    raw = model_bytes(model)

    def per_batch(column):
        c = codec(raw)
        return [pa.array([c.decode(x.as_py() or []) for x in column], pa.string())]
    return _extended(docs, per_batch, ids, [T.StructField("decoded", T.StringType())])


def round_trip(docs: DataFrame, model: str, text: str = "text", check: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (of the decimal ids joined by commas)
    and decoded_sha256 (of the text that the ids decode to).  Ids and texts
    stay within the batch."""
    raw = model_bytes(model)

    def per_batch(texts):
        c = codec(raw)
        n, by_ids, by_text = [], [], []
        for part in _sliced(texts):
            for ids in c.encode_all(part, check):
                n.append(len(ids))
                by_ids.append(sha256(",".join(map(c.digits.__getitem__, ids)).encode()).hexdigest())
                by_text.append(sha256(c.decode(ids).encode()).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())]
    return _extended(docs, per_batch, text, [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())])
