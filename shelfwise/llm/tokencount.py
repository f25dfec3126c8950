"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pieces as its vocabulary file says; the symbols of a piece
form a linked list, and a heap holds its adjacent pairs by merge rank and place.
The lowest pair is popped and merged until none is left. Each merge shortens the
list by one, so a piece has as many tokens as it had symbols, less its merges;
no token identifiers are made.

The file is a ``tokenizers`` JSON with a BPE model, an end-of-word suffix, the
normalisers NFC, white space to blanks and lower case, and a removing Split
pattern. Added special strings inside a text count as one token each, as the
library does by default.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import keyed, tidy

#: Entries a worker keeps of pieces it has counted; the memory is emptied when full.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
#: White space of the Unicode standard, of which str.split() has four more members.
_BLANKS = re.compile("[\t-\r \x85\xa0  -     　]+")
_MORE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free code from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Counter(dict):
    """Counts tokens; as a dict, it remembers the counts of blank-free stretches of normalised text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is not a word-end BPE file with lower case")
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {ids[a] << 32 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        symbols = byte_symbols()
        self.inner = [ids[c] for c in symbols]
        self.final = [ids[c + model["end_of_word_suffix"]] for c in symbols]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces: dict[str, int] = {}

    def merged(self, piece: bytes) -> int:
        """Tokens of one piece."""
        symbols = [self.inner[b] for b in piece]
        symbols[-1] = self.final[piece[-1]]
        last = len(symbols)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        merges, count = self.merges, last
        heap = []
        for i in range(last - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= last:
                continue
            found = merges.get(symbols[i] << 32 | symbols[j])
            if not found or found[0] != rank:
                continue
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            count -= 1
            if k < last:
                before[k] = i
                found = merges.get(made << 32 | symbols[k])
                if found:
                    heapq.heappush(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] << 32 | made)
                if found:
                    heapq.heappush(heap, (found[0], h, found[1]))
        return count

    def piece(self, piece: str) -> int:
        count = self.pieces.get(piece)
        if count is None:
            count = self.merged(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= LONGEST_REMEMBERED:
                if len(self.pieces) >= REMEMBERED:
                    self.pieces.clear()
                self.pieces[piece] = count
        return count

    def __missing__(self, stretch: str) -> int:
        count = sum(map(self.piece, self.pattern.findall(stretch)))
        if len(stretch) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[stretch] = count
        return count

    def plain(self, text: str) -> int:
        # One character at a time, as the library lowers: a capital sigma never becomes a final one.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        stretches = text.split() if not _MORE.search(text) else [s for s in _BLANKS.split(text) if s]
        return sum(map(self.__getitem__, stretches))

    def count(self, text: str) -> int:
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) for every row of ``docs``; null counts as the empty text (no tokens).

    ``path`` is the vocabulary file's place on every worker. Repeated rows are
    counted each, other columns are not read.
    """
    rows = keyed(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    kind = rows.schema["id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                counts = [known.count(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    counted = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
