"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

A text is read as its UTF-8 bytes, ASCII letters in lower case, in units of one
word (a word over ``UNIT`` bytes makes several). Over each unit two gated
recurrent layers run, one in each direction; their states at a byte give that
byte's probabilities over the languages, and a document's probabilities are the
mean over all positions of its letters. As the states in a unit depend on its
bytes alone, a task runs the network once for each different unit of a block of
texts.

Training is backpropagation through time with Adam on a sample bounded by the
parameters in ``Settings``; prediction reads every whole text. The model that
tasks get has a fixed size of some 60 KB and a column per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import bounded_sample, byte_view, cuts, keyed, tidy

UNIT = 16
BLOCK = 8 << 20
#: With more languages than this, blocks are smaller in proportion, so that a task's memory stays.
WIDE = 50
NONE = "und"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of letters: ASCII letters, and every byte of a longer character.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


@dataclass(frozen=True)
class Settings:
    rows: int = 300  # documents of each language that training may read
    chars: int = 2500  # characters of each, from a place its hash picks
    total: int = 12000  # documents in all; with more languages than this allows for, each has fewer, and one at least
    hidden: int = 8
    steps: int = 500
    batch: int = 512
    rate: float = 0.01
    seed: int = 11


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct units as rows of ``UNIT`` bytes padded with zeros, unit of each occurrence, its document)."""
    data = np.where(data == 0, np.uint8(32), _LOWER[data])
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    first[edges] = inside[edges]
    place = np.arange(len(data))
    since = place - np.maximum.accumulate(np.where(first, place, 0))
    starts = np.flatnonzero(inside & (since % UNIT == 0))
    stops = np.flatnonzero(np.concatenate((~inside | first, [True])))
    length = np.minimum(stops[np.searchsorted(stops, starts + 1)] - starts, UNIT)
    grid = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(UNIT, np.uint8))), UNIT)[starts]
    grid[np.arange(UNIT) >= length[:, None]] = 0
    words = grid.view(np.uint64)
    key = words[:, 0] * np.uint64(0x9E3779B97F4A7C15)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[:, 1] * np.uint64(0x94D049BB133111EB)
    _, at, which = np.unique(key, return_index=True, return_inverse=True)
    return grid[at], which, np.searchsorted(offsets, starts, "right") - 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _layer(table: np.ndarray, inner: np.ndarray, columns: list[np.ndarray], keep: bool) -> tuple[list[np.ndarray], list]:
    """States after each of ``columns`` (a byte of every unit); zero bytes leave the state as it is."""
    size = inner.shape[0]
    state = np.zeros((len(columns[0]), size), np.float32)
    states, memory = [], []
    for column in columns:
        drive, pull = table[column], state @ inner
        gates = _sigmoid(drive[:, : 2 * size] + pull[:, : 2 * size])
        update, reset = gates[:, :size], gates[:, size:]
        fresh = np.tanh(drive[:, 2 * size :] + reset * pull[:, 2 * size :])
        real = (column != 0)[:, None]
        if keep:
            memory.append((state, update, reset, fresh, pull[:, 2 * size :], real))
        state = np.where(real, fresh + update * (state - fresh), state)
        states.append(state)
    return states, memory


def _layer_back(table: np.ndarray, inner: np.ndarray, columns: list, memory: list, outer: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``table`` and ``inner`` from those of the states, back through time."""
    d_table, d_inner = np.zeros_like(table), np.zeros_like(inner)
    flow = np.zeros_like(outer[0])
    size = inner.shape[0]
    for column, (state, update, reset, fresh, pull, real), given in zip(columns[::-1], memory[::-1], outer[::-1]):
        flow = flow + given
        live = np.where(real, flow, 0)
        d_fresh = live * (1 - update) * (1 - fresh * fresh)
        d_update = live * (state - fresh) * update * (1 - update)
        d_reset = d_fresh * pull * reset * (1 - reset)
        d_drive = np.concatenate((d_update, d_reset, d_fresh), 1)
        d_pull = np.concatenate((d_update, d_reset, d_fresh * reset), 1)
        order = np.argsort(column, kind="stable")
        codes, at = np.unique(column[order], return_index=True)
        d_table[codes] += np.add.reduceat(d_drive[order], at)
        d_inner += state.T @ d_pull
        flow = np.where(real, live * update, flow) + d_pull @ inner.T
    return d_table, d_inner


def _forward(params: list[np.ndarray], grid: np.ndarray, keep: bool = False):
    longest = int((grid != 0).any(0).nonzero()[0].max(initial=0)) + 1
    columns = [np.ascontiguousarray(grid[:, i]) for i in range(longest)]
    ahead, memory = _layer(params[0], params[1], columns, keep)
    behind, memory_back = _layer(params[2], params[3], columns[::-1], keep)
    both = np.stack([np.concatenate((a, b), 1) for a, b in zip(ahead, behind[::-1])])
    logits = both @ params[4] + params[5]
    probs = np.exp(logits - logits.max(2, keepdims=True))
    probs /= probs.sum(2, keepdims=True)
    return probs, _LETTER[np.stack(columns)], both, columns, memory, memory_back


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    params: tuple[np.ndarray, ...]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over the letter positions of each document; zeros where it has none."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        grid, which, doc = units(data, offsets)
        if not len(doc) or not self.params:
            return total
        score, letters = np.zeros((len(grid), len(self.languages))), np.zeros(len(grid))
        by_length = np.argsort((grid != 0).sum(1), kind="stable")
        step = max(64, 4096 * WIDE // max(WIDE, len(self.languages)))
        for low in range(0, len(grid), step):
            some = by_length[low : low + step]
            probs, mask, *_ = _forward(self.params, grid[some])
            score[some] = (probs * mask[:, :, None]).sum(0)
            letters[some] = mask.sum(0)
        weight = np.maximum(np.bincount(doc, letters[which], len(total)), 1e-9)
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(doc, score[which, k], len(total)) / weight
        return total


def train(texts: list[str], langs: list[str], settings: Settings = Settings()) -> Model:
    """Fit the network to the languages' units; every position of a unit is labelled with the languages it occurs in."""
    names = tuple(sorted(set(langs)))
    if not names:
        return Model((), ())
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    grid, which, doc = units(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    place = {name: i for i, name in enumerate(names)}
    label = np.array([place[x] for x in langs], dtype=int)[doc]
    if not len(grid):
        return Model(names, ())
    # A unit occurs in few languages, so its shares are kept as pairs, not as a row of all.
    pair, many = np.unique(which.astype(np.int64) * len(names) + label, return_counts=True)
    unit, lang = np.divmod(pair, len(names))
    share = many / np.bincount(label, minlength=len(names))[lang]
    whole, starts = np.bincount(unit, share, len(grid)), np.searchsorted(unit, np.arange(len(grid) + 1))
    share, pick = share / whole[unit], np.sqrt(whole)
    rng, size = np.random.default_rng(settings.seed), settings.hidden
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5 if shape[0] != 256 else 0.3, shape).astype(np.float32)
    params = [draw(256, 3 * size), draw(size, 3 * size), draw(256, 3 * size), draw(size, 3 * size), draw(2 * size, len(names)), np.zeros(len(names), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, settings.steps + 1):
        some = rng.choice(len(grid), settings.batch, p=pick / pick.sum())
        probs, mask, both, columns, memory, memory_back = _forward(params, grid[some], True)
        size_of = starts[some + 1] - starts[some]
        at = np.arange(size_of.sum()) + np.repeat(starts[some] - np.cumsum(size_of) + size_of, size_of)
        target = np.zeros((len(some), len(names)), np.float32)
        target[np.repeat(np.arange(len(some)), size_of), lang[at]] = share[at]
        error = (probs - target) * mask[:, :, None] / max(1, mask.sum())
        outer = error @ params[4].T
        ahead = _layer_back(params[0], params[1], columns, memory, list(outer[:, :, :size]))
        behind = _layer_back(params[2], params[3], columns[::-1], memory_back, list(outer[::-1, :, size:]))
        grads = [*ahead, *behind, np.einsum("tnh,tnk->hk", both, error, optimize=True), error.sum((0, 1))]
        rate = settings.rate * min(1.0, 2 * (1 - step / (settings.steps + 1)))
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Model(names, tuple(params))


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on a bounded sample of ``labelled`` (id, text, lang); rows without text or language are not used."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = [r.lang for r in rows.select("lang").distinct().collect()]
    if not langs:
        return Model((), ())
    each = max(1, min(settings.rows, settings.total // len(langs)))
    at = F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - settings.chars, F.lit(0)) + 1)
    cut = F.substr("text", at.cast("int") + 1, F.lit(settings.chars))
    got = bounded_sample(rows, dict.fromkeys(langs, each), "lang", settings.seed, cut).collect()
    got.sort(key=lambda r: (r.id, r.lang, r.text))
    return train([r.text for r in got], [r.lang for r in got], settings)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) for every row of ``docs``.

    Null, empty and letterless texts are ``und`` with score 0, as is everything
    when no language was learned; ties go to the language first by name.
    Repeated rows are predicted each; other columns are not read.
    """
    rows = keyed(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_view(batch.column(1))
            for low, high in cuts(offsets, BLOCK * WIDE // max(WIDE, len(model.languages))):
                part = slice(int(offsets[low]), int(offsets[high]))
                probs = model.predict(data[part], offsets[low : high + 1] - offsets[low])
                texts = batch.column(1).slice(low, high - low).to_pylist()
                known = np.array([any(map(str.isalpha, t or "")) for t in texts]) & (probs.sum(1) > 0 if probs.size else False)
                best = probs.argmax(1) if probs.size else np.zeros(high - low, int)
                top = np.where(known, np.minimum(probs.max(1), 1), 0.0) if probs.size else np.zeros(high - low)
                lang = [model.languages[b] if k else NONE for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(lang, pa.string()), pa.array(top, pa.float64())], ["id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
