"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is a run of letters or digits, set in lower case. Its subwords are the
character 4- and 6-grams of the word between boundary marks, hashed into a fixed
table of embedding rows. A word is the mean of its subwords, a document the mean
of its words, and a linear softmax over that mean gives the probability. A
misspelling shares most subwords with the word it hides, so it lands nearby
without having been seen.

Training is bounded by the two parameters ``rows`` and ``chars`` of ``Settings``
(the classifier's sample); scoring reads every whole text. As the softmax is
linear, a subword adds one number to a document's logit, so the model that tasks
get is one float per table row: 1 MB, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import bounded_sample, cuts, give_back, keyed, small_batches, tidy

BITS = 18
SIZES = (4, 6)
#: Words without weight that every document is taken to have besides its own, so that one odd word of a short text does not decide.
SMOOTH = 8
BLOCK_CHARS = 1 << 18
ENTRIES = 1 << 20
_LETTER = np.array([chr(i).isalnum() for i in range(1 << 16)])


@dataclass(frozen=True)
class Settings:
    toxic_rows: int = 1600  # labelled documents that training may read, by label
    clean_rows: int = 6000
    chars: int = 3000  # characters of a training document, from a place its hash picks
    least: int = 5  # training documents a subword must occur in
    dim: int = 2
    epochs: int = 40
    rate: float = 0.1
    ridge: float = 1e-3
    seed: int = 7


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # what a subword adds to the logit, per table row
    bias: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for low, high in _blocks(texts):
            gram, word, doc = subwords(texts[low:high])
            if len(doc):
                size = np.bincount(word, minlength=len(doc))
                mean = np.bincount(word, self.weight[gram], len(doc)) / np.maximum(size, 1)
                words = np.bincount(doc, minlength=high - low)
                out[low:high] += np.bincount(doc, mean, high - low) / (words + SMOOTH)
        return out


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    low = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def subwords(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table row, word) of every subword and the document of every word."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\0" + "\0".join(lowered) + "\0\0\0\0\0\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.where(codes < len(_LETTER), _LETTER[np.minimum(codes, len(_LETTER) - 1)], True)
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = 1 + np.cumsum([len(t) + 1 for t in lowered])
    doc = np.searchsorted(ends, starts, "right")
    word = np.cumsum(np.concatenate(([False], inside[1:] & ~inside[:-1]))) - 1
    outside = np.concatenate(([0], np.cumsum(~inside)))
    letters = np.where(inside, codes, 0).astype(np.uint64)
    mark, rows, of = letters.copy(), [], []
    last = len(codes) - max(SIZES)
    for n in range(2, max(SIZES) + 1):
        mark = mark[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + letters[n - 1 :] + np.uint64(n)
        if n in SIZES:
            at = np.flatnonzero(outside[n - 1 : n - 1 + last + 1] == outside[1 : last + 2])
            mixed = mark[at]
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            rows.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
            of.append(word[at + 1])
    return np.concatenate(rows), np.concatenate(of), doc


def train(texts: list[str], labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Fit embeddings and softmax together by full-batch gradient descent; with one label only, the score is that label's share, and without any a third."""
    if not len(texts) or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1.5)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(settings.seed)
    doc, gram, value = _weights(texts, settings.least)
    give_back()
    if not len(gram):
        return train([], labels, settings)
    n, dim = len(texts), settings.dim
    count = _totals(gram, None, 1 << BITS)
    used = np.flatnonzero(count)
    np.take(np.cumsum(count > 0, dtype=np.int32) - 1, gram, out=gram, mode="clip")
    # Documents come in order.
    doc_starts = np.concatenate(([0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]))
    filled = doc[doc_starts[:-1]]
    embed, slow = np.zeros((len(used), dim), np.float32), np.zeros((len(used), dim), np.float32)
    soft = rng.normal(0, 1, (dim, 2)).astype(np.float32)
    soft -= soft.mean(1, keepdims=True)
    soft /= np.linalg.norm(soft[:, 1] - soft[:, 0])
    slow_soft, bias = np.zeros_like(soft), np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[labels.astype(int)]
    # A row's step follows its curvature, so that a subword of many documents and one of few learn alike.
    rate = (settings.rate / (_totals(gram, lambda a, b: value[a:b] ** 2, len(used)) + settings.ridge)).astype(np.float32)
    for _ in range(settings.epochs):
        bag = np.zeros((n, dim), np.float32)
        for k in range(dim):
            bag[filled, k] = _sums(embed[:, k], gram, value, doc_starts)
        z = bag @ soft + bias
        p = np.exp(z - z.max(1, keepdims=True))
        error = p / p.sum(1, keepdims=True) - target
        back = error @ soft.T
        for k in range(dim):
            pull = _totals(gram, lambda a, b: back[doc[a:b], k] * value[a:b], len(used)).astype(np.float32)
            slow[:, k] = 0.9 * slow[:, k] - rate * (pull + 0.02 * settings.ridge * embed[:, k])
        slow_soft = 0.9 * slow_soft - 0.002 * (bag.T @ error) / (n * (np.square(bag).mean() + 1e-6))
        embed += slow
        soft += slow_soft
        bias -= 0.5 * error.mean(0)
    weight = np.zeros(1 << BITS, np.float32)
    weight[used] = embed @ (soft[:, 1] - soft[:, 0])
    return Model(weight, float(bias[1] - bias[0]))


def _sums(of: np.ndarray, index: np.ndarray, weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``of[index] * weight`` between ``bounds``, a part at a time, which keeps the driver's memory low."""
    out = np.empty(len(bounds) - 1, np.float32)
    for low, high in cuts(bounds, ENTRIES):
        a, b = bounds[low], bounds[high]
        out[low:high] = np.add.reduceat(of[index[a:b]] * weight[a:b], bounds[low:high] - a)
    return out


def _totals(index: np.ndarray, weights: Callable[[int, int], np.ndarray] | None, size: int) -> np.ndarray:
    """``np.bincount``, a part at a time: the driver holds neither a sorted copy of the entries nor a wide one."""
    out = np.zeros(size)
    for a in range(0, len(index), ENTRIES):
        b = min(a + ENTRIES, len(index))
        out += np.bincount(index[a:b], None if weights is None else weights(a, b), size)
    return out


def _weights(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, table row, share of the document's mean) of the subwords that occur in ``least`` documents or more."""
    docs, grams, values = [np.zeros(0, np.int16)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    for low, high in _blocks(texts):
        gram, word, doc = subwords(texts[low:high])
        if len(gram):
            size, words, of = np.bincount(word, minlength=len(doc)), np.bincount(doc, minlength=high - low), doc[word]
            pair, at = np.unique((of + low).astype(np.int64) << BITS | gram, return_inverse=True)
            docs.append((pair >> BITS).astype(np.int16 if len(texts) < 1 << 15 else np.int32))
            grams.append((pair & ((1 << BITS) - 1)).astype(np.int32))
            values.append(np.bincount(at, 1.0 / (size[word] * (words[of] + SMOOTH)), len(pair)).astype(np.float32))
    common = sum(np.bincount(gram, minlength=1 << BITS) for gram in grams) >= min(least, max(1, len(texts) // 20))
    for k, gram in enumerate(grams):
        kept = common[gram]
        docs[k], grams[k], values[k] = docs[k][kept], gram[kept], values[k][kept]
    return _joined(docs), _joined(grams), _joined(values)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """All parts in one array; each is let go once it is copied, so that they are not held twice."""
    out, at = np.empty(sum(map(len, parts)), parts[-1].dtype), 0
    parts.reverse()
    while parts:
        part = parts.pop()
        out[at : at + len(part)] = part
        at += len(part)
    return out


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on a bounded sample of ``labelled`` (id, text, label 0/1); rows without text or label are not used."""
    rows = labelled.where(F.col("label").isin(0, 1) & F.col("text").isNotNull())
    length, at = F.length("text"), F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - settings.chars, F.lit(0)) + 1)
    cut = F.when(length <= settings.chars, F.col("text")).otherwise(F.substr("text", at.cast("int") + 1, F.lit(settings.chars)))
    got = bounded_sample(rows, {0: settings.clean_rows, 1: settings.toxic_rows}, "label", settings.seed, cut).collect()
    got.sort(key=lambda r: (r.id, r.label, r.text))
    texts, labels = [r.text for r in got], np.array([r.label for r in got], dtype=int)
    del got
    give_back()
    try:
        return train(texts, labels, settings)
    finally:
        # The driver goes on to other stages, which should not pay for the trainer's memory.
        give_back()


def score_texts(model: Model):
    """The function for ``mapInArrow`` over (id, text): (id, score)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            for low in range(0, len(batch), 512):
                part = text.slice(low, 512)
                score = 1 / (1 + np.exp(-model.logits(part.to_pylist())))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, 512), pa.array(score, pa.float64())], ["id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for every row of ``docs``; null and empty texts get the model's prior.

    Repeated rows are scored each; an empty table gives an empty result; other
    columns are not read. Ids may be null.
    """
    rows = keyed(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score_texts(model), f"id {kind}, score double").withColumnRenamed("id", id_col)


def training_rows(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, text, label) of the documents that have a label and satisfy ``use`` (a condition on ``id``).

    Several labels of one id count as toxic if one of them is; ids without a
    document, and documents without a label, are left out.
    """
    marks = keyed(labels, id=id_col, label=label_col).where("label IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    return keyed(docs, id=id_col, text=text_col).where(use).join(marks.where(use), "id")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``; rows pass through one map, nothing is shuffled."""
    place = small_batches(docs).columns.index(text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.slice(low, 512)
                score = 1 / (1 + np.exp(-model.logits(part.column(place).to_pylist())))
                yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)
