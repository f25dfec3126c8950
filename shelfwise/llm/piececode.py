"""SentencePiece encoding and decoding by vectorised merge rounds.

The new words of a block of texts become one flat array of symbols. A round looks
up every adjacent pair, takes each word's smallest pair rank, merges all its
places at once from the left, and closes the gaps; words without a pair drop out,
and the rounds end when none is left. Words are remembered per worker (bounded),
so a round works on new words only.

Merging all places of a rank at once equals merging the leftmost one again and
again if the piece made has no better or equal pair with any neighbour. Pieces
that may have one (known from the vocabulary) are merged place by place, each
followed at once by the better pairs that it opens.

The file is a SentencePiece model of kind BPE with byte fallback, the identity
normaliser, a dummy prefix, white space kept, and no user-defined or unused
pieces; other files are refused.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_view, cuts, keyed, tidy

#: Words that a worker remembers, and their characters; between blocks of texts the memory is emptied when one is passed.
REMEMBERED = 500_000
REMEMBERED_CHARS = 8_000_000
BLANK = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_NONE = np.int64(1) << 40


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class _Words(dict):
    """Numbers words in the order in which they are first asked for; ``fresh`` are those whose ids aren't kept yet."""

    def __init__(self):
        self.fresh: list[str] = []
        self.chars = 0
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        self.chars += len(word)
        return number

    def keep(self, ids: list[np.ndarray]) -> None:
        """Take the ids of the fresh words."""
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum([len(i) for i in ids])))
        self.ids = np.concatenate((self.ids, *ids))
        self.fresh = []


class Model:
    """A vocabulary as arrays; symbols are piece ids, then characters that only occur inside pieces, or -1 - code point."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        found = [dict(_fields(v)) for k, v in parts if k == 1]
        trainer, normaliser = (dict(_fields(next((v for k, v in parts if k == n), b""))) for n in (2, 3))
        self.texts = [p[1].decode() for p in found]
        self.kinds = np.array([p.get(3, NORMAL) for p in found])
        scores = np.array([struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in found])
        plain = trainer.get(3) == 2 and trainer.get(35) and not trainer.get(24)
        if not plain or normaliser.get(2) or not normaliser.get(3, 1) or normaliser.get(4, 1) or not normaliser.get(5, 1):
            raise ValueError(f"{path} is not a BPE model with byte fallback, identity normaliser and dummy prefix")
        if not np.isin(self.kinds, (NORMAL, UNKNOWN, CONTROL, BYTE)).all() or (self.kinds == BYTE).sum() != 256:
            raise ValueError(f"{path} has pieces of other kinds")
        normal = np.flatnonzero(self.kinds == NORMAL).tolist()
        symbols = {self.texts[i]: i for i in normal}
        if any(BLANK in t.lstrip(BLANK) for t in symbols):
            raise ValueError(f"{path} has pieces that go on after a blank")
        self.size = len(found)
        for t in list(symbols):
            for c in t:
                symbols.setdefault(c, self.size + len(symbols))
        self._of_char = np.full(0x110000, _NONE, np.int64)
        for t, i in symbols.items():
            if len(t) == 1:
                self._of_char[ord(t)] = i
        #: Symbols past the pieces are characters; by number, their code points.
        self._loose = {i: ord(t) for t, i in symbols.items() if i >= self.size}
        unknown = np.flatnonzero(self._of_char == _NONE)
        self._of_char[unknown] = -1 - unknown
        # Ranks of pieces by score, equal ones alike; the pairs that make each piece.
        rank = np.full(self.size, _NONE)
        rank[normal] = np.unique(-scores[normal], return_inverse=True)[1]
        keys, made, inner, loud = [], [], set(), set()
        for i in normal:
            t = self.texts[i]
            inner.update(zip(t, t[1:]))
            for cut in range(1, len(t)):
                a, b = symbols.get(t[:cut]), symbols.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(i)
                    loud.update(int(rank[p]) for p in (a, b) if p < self.size and rank[p] >= rank[i])
        order = np.argsort(np.array(keys, np.int64))
        # A last entry that no pair has, so that a search always ends on an entry.
        self._keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self._made = np.append(np.array(made, np.int64)[order], 0)
        self._rank = np.append(rank[self._made[:-1]], _NONE)
        self._loud = np.zeros(int(rank[normal].max(initial=0)) + 1, bool)
        self._loud[list(loud)] = True
        self._inner = np.unique(np.array([ord(a) << 32 | ord(b) for a, b in inner] or [-1], np.int64))
        # What a piece reads as; bytes by their value.
        byte_ids = np.flatnonzero(self.kinds == BYTE)
        self._byte_id = np.zeros(256, np.int64)
        self._byte_id[[int(self.texts[i][3:5], 16) for i in byte_ids]] = byte_ids
        read = [t.replace(BLANK, " ").encode() for t in self.texts]
        for value, i in enumerate(self._byte_id.tolist()):
            read[i] = bytes([value])
        surface = trainer.get(44, " ⁇ ".encode())
        read = [b"" if k == CONTROL else surface if k == UNKNOWN else r for r, k in zip(read, self.kinds.tolist())]
        self._read = np.frombuffer(b"".join(read), np.uint8)
        self._read_at = np.concatenate(([0], np.cumsum([len(r) for r in read])))
        self._opens = np.array([k == NORMAL and t.startswith(BLANK) for t, k in zip(self.texts, self.kinds.tolist())])
        self._words = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.known = _Words()

    # --- encoding ---

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of adjacent symbols; rank ``_NONE`` where they make no piece."""
        key = np.where((left < 0) | (right < 0), np.int64(-1), left << 32 | right)
        at = np.searchsorted(self._keys, key)
        hit = self._keys[at] == key
        return np.where(hit, self._rank[at], _NONE), self._made[at]

    def _one(self, left: int, right: int) -> tuple[int, int]:
        if left < 0 or right < 0:
            return int(_NONE), 0
        key = left << 32 | right
        at = int(np.searchsorted(self._keys, key))
        return (int(self._rank[at]), int(self._made[at])) if self._keys[at] == key else (int(_NONE), 0)

    def _careful(self, places: np.ndarray, symbols: np.ndarray, word: np.ndarray, piece: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The symbols of words in which a merge at one of ``places`` opens a pair that is as good, or in which there are several."""
        out = np.zeros(len(symbols), bool)
        if len(places):
            made = piece[places]
            left, right = np.maximum(places - 1, 0), np.minimum(places + 2, len(symbols) - 1)
            before = np.where((places > 0) & (word[left] == word[places]), self._pairs(symbols[left], made)[0], _NONE)
            after = np.where((places + 2 < len(symbols)) & (word[right] == word[places]), self._pairs(made, symbols[right])[0], _NONE)
            opens = np.minimum(before, after) <= level[places]
            again = word[places][1:] == word[places][:-1]
            opens[1:] |= again
            opens[:-1] |= again
            out = np.isin(word, word[places][opens])
        return out

    def _cascade(self, places: np.ndarray, symbols: np.ndarray, word: np.ndarray, level: np.ndarray, alive: np.ndarray) -> None:
        """Merge at ``places``, from the left, and after each one the pairs it opens that are as good or better."""
        after: dict[int, int] = {}
        before: dict[int, int] = {}
        last = len(symbols)

        def next_of(i: int) -> int:
            j = after.get(i, i + 1)
            return j if j < last and word[j] == word[i] else -1

        def last_of(i: int) -> int:
            j = before.get(i, i - 1)
            return j if j >= 0 and word[j] == word[i] else -1

        for i in places.tolist():
            bar = int(level[i])
            while alive[i]:
                j, h = next_of(i), last_of(i)
                found = [(*self._one(int(symbols[a]), int(symbols[b])), a, b) for a, b in ((h, i), (i, j)) if a >= 0 and b >= 0]
                best = min(found, key=lambda x: (x[0], x[2]), default=(int(_NONE), 0, 0, 0))
                if best[0] > bar:
                    break
                _, piece, a, b = best
                symbols[a], alive[b] = piece, False
                c = after.get(b, b + 1)
                after[a] = c
                before[c] = a
                i = a

    def merged(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word (a text's stretch from one blank to the next), without memory."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        symbols, place = self._of_char[codes], np.arange(len(codes))
        # Characters that stand side by side in no piece are never merged: what lies between such places is a word of its own.
        new = np.ones(len(codes), bool)
        if len(codes) > 1:
            new[1:] = ~np.isin(codes[:-1] << 32 | codes[1:], self._inner)
        new[ends[:-1]] = True
        word = np.cumsum(new)
        done_symbols, done_place = [], []
        while len(symbols):
            rank = np.full(len(symbols), _NONE)
            piece = np.zeros(len(symbols), np.int64)
            rank[:-1], piece[:-1] = self._pairs(symbols[:-1], symbols[1:])
            rank[:-1][word[1:] != word[:-1]] = _NONE
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(starts, len(word)))
            level = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            active = level < _NONE
            if not active.all():
                done_symbols.append(symbols[~active])
                done_place.append(place[~active])
                symbols, place, word, rank, piece, level = (x[active] for x in (symbols, place, word, rank, piece, level))
                if not len(symbols):
                    break
            hit = rank == level
            alive = np.ones(len(symbols), bool)
            careful = self._careful(np.flatnonzero(hit & self._loud[level]), symbols, word, piece, level)
            quiet = hit & ~careful
            # In a run of overlapping places every second one is merged, from the left.
            run_start = np.maximum.accumulate(np.where(quiet & ~np.concatenate(([False], quiet[:-1])), np.arange(len(quiet)), 0))
            take = np.flatnonzero(quiet & ((np.arange(len(quiet)) - run_start) % 2 == 0))
            symbols[take] = piece[take]
            alive[take + 1] = False
            self._cascade(np.flatnonzero(hit & careful), symbols, word, level, alive)
            symbols, place, word = symbols[alive], place[alive], word[alive]
        symbols, place = np.concatenate(done_symbols or [symbols]), np.concatenate(done_place or [place])
        order = np.argsort(place)
        symbols, place = symbols[order], place[order]
        bounds = np.searchsorted(place, ends)
        odd = (symbols < 0) | (symbols >= self.size)
        out, low = [], 0
        for high in bounds.tolist():
            ids = symbols[low:high]
            if odd[low:high].any():
                ids = np.concatenate([self._ids(int(s)) for s in ids.tolist()])
            out.append(ids.astype(np.int32))
            low = high
        return out

    def _ids(self, symbol: int) -> np.ndarray:
        """A piece's id, or the ids of the bytes of a character that is no piece."""
        if 0 <= symbol < self.size:
            return np.array([symbol])
        code = self._loose[symbol] if symbol >= 0 else -1 - symbol
        return self._byte_id[np.frombuffer(chr(code).encode("utf-8", "surrogatepass"), np.uint8)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the texts' offsets in them."""
        known = self.known
        if len(known) > REMEMBERED or known.chars > REMEMBERED_CHARS:
            known = self.known = _Words()
        find, split = known.__getitem__, self._words.findall
        each = [list(map(find, split(BLANK + t.replace(" ", BLANK)))) if t else [] for t in texts]
        if known.fresh:
            known.keep(self.merged(known.fresh))
        words = np.fromiter(itertools.chain.from_iterable(each), np.int64)
        starts, sizes = known.starts[words], known.starts[words + 1] - known.starts[words]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        flat = known.ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        return flat, ends[np.concatenate(([0], np.cumsum([len(x) for x in each], dtype=np.int64)))]

    # --- decoding ---

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The UTF-8 bytes of all texts, and the texts' offsets in them."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is not in the vocabulary")
        starts, sizes = self._read_at[ids], self._read_at[ids.astype(np.int64) + 1] - self._read_at[ids]
        # The blank that encoding put before a text goes again: from the first id that isn't a control piece.
        says = np.flatnonzero(self.kinds[ids] != CONTROL)
        first = np.searchsorted(says, offsets[:-1])
        there = first < len(says)
        there[there] &= says[first[there]] < offsets[1:][there]
        opening = says[first[there]]
        opening = opening[self._opens[ids[opening]]]
        starts[opening] += 1
        sizes[opening] -= 1
        ends = np.concatenate(([0], np.cumsum(sizes)))
        out = self._read[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])] if ends[-1] else np.zeros(0, np.uint8)
        if len(says) == len(ids):  # a control piece reads as nothing but parts the bytes on its sides
            try:
                out.tobytes().decode()
                return out, ends[offsets]
            except UnicodeDecodeError:
                pass
        return self._mended(out, ids, offsets, ends)

    def _mended(self, out: np.ndarray, ids: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``decode``, where runs of byte pieces are no UTF-8: each byte that begins no character becomes U+FFFD."""
        texts = []
        is_byte = self.kinds[ids] == BYTE
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            parts, at = [], low
            while at < high:
                to = at + 1
                while to < high and is_byte[to] == is_byte[at]:
                    to += 1
                part = out[ends[at] : ends[to]].tobytes()
                parts.append(_valid(part) if is_byte[at] else part)
                at = to
            texts.append(b"".join(parts))
        sizes = np.array([len(t) for t in texts], np.int64)
        return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum(sizes)))


def _valid(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        part = data[at : at + size]
        try:
            ok = len(part.decode()) == 1
        except UnicodeDecodeError:
            ok = False
        out.append(part if ok else "�".encode())
        at += size if ok else 1
    return b"".join(out)


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) for every row of ``docs``; null counts as the empty text, which has no ids.

    ``path`` is the model file's place on every worker. No begin and end ids are
    added. Repeated rows are encoded each, other columns are not read. An empty
    table gives an empty result.
    """
    rows = keyed(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in batches:
            _, bounds = byte_view(batch.column(1))
            for low, high in cuts(bounds):
                part = batch.slice(low, high - low)
                flat, offsets = known.encode([t or "" for t in part.column(1).to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["id", "ids"])

    return rows.mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids_col`` (array<int>) as another column ``text_col``; it replaces one of that name.

    A null list or a null id gives a null text, an empty list the empty one. An id
    outside the vocabulary is an error.
    """
    kept = [c for c in rows.columns if c.lower() != text_col.lower()]
    usable = F.col(f"`{ids_col}`").isNotNull() & F.forall(f"`{ids_col}`", lambda x: x.isNotNull())
    given = rows.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)), F.when(usable, F.col(f"`{ids_col}`")).cast("array<int>").alias("ids"))
    schema = given.drop("ids").schema.add("decoded", "string")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))))
            for low, high in cuts(bounds, 1 << 18):
                part = batch.slice(low, high - low)
                flat = part.column(part.num_columns - 1).flatten().to_numpy()
                out, offsets = known.decode(flat, bounds[low : high + 1] - bounds[low])
                gone = part.column(part.num_columns - 1).is_null()
                text = pa.LargeStringArray.from_buffers(high - low, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out.tobytes()))
                text = pa.compute.if_else(gone, None, text).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], text], schema.names)

    made = given.mapInArrow(run, schema)
    return made.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(kept)), F.col("decoded").alias(text_col))
