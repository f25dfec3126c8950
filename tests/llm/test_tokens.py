"""Token counts, packing and mixing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward_texts, docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import mixing, packing, queries, tokencount

WORDS, BYTES = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


def test_counts_equal_the_library(spark, word_library):
    texts = awkward_texts()
    got = {r.doc_id: r for r in tokencount.count_tokens(docs(spark, texts), WORDS).collect()}
    for i, t in enumerate(texts):
        n = len(word_library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 2048)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.lists(st.sampled_from(["the ", "'S", "ΑΣ", "<|endoftext|>", "\x1c", "\u0085", "é", "İ", "12a"])).map("".join))
def test_any_text_counts_like_the_library(word_library, text):
    assert tokencount.counter(WORDS).count(text) == len(word_library.encode(text, add_special_tokens=False).ids)


def test_a_full_memory_is_emptied(monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED", 2)
    one = tokencount.Counter(WORDS)
    texts = ["some words here", "more words there", "some words here"]
    assert [one.count(t) for t in texts] == [tokencount.counter(WORDS).count(t) for t in texts]
    assert len(one) <= 2 and len(one.pieces) <= 2


def cut(ids, capacity=2048):
    first = len(ids) % capacity or capacity
    edges = [0, *range(first, len(ids), capacity), len(ids)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]


def test_pieces_equal_the_library(spark, byte_library):
    texts = awkward_texts() + ["x" * 9000, "the " * 2047, "the " * 2048]
    got = {}
    for r in queries.pieces_of(docs(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
        assert r.length == len(r.ids) // 4
    for i, t in enumerate(texts):
        assert sorted(got[i]) == cut(byte_library.encode(t or "", add_special_tokens=False).ids + [0])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text_has_the_library_ids(byte_library, text):
    import tiktoken  # noqa: F401

    encoder = packing._encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, (("<|endoftext|>", 50256),))
    assert encoder.encode(text, allowed_special="all") == byte_library.encode(text, add_special_tokens=False).ids


def check_packing(rows, capacity):
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


@pytest.mark.parametrize("kind", ["mixed", "tiny", "half", "full", "one length"])
def test_packing_is_gapless_and_tight(spark, kind):
    rng = random.Random(1)
    lengths = {
        "mixed": [rng.randint(1, 100) for _ in range(900)],
        "tiny": [rng.randint(1, 3) for _ in range(900)],
        "half": [rng.choice([50, 51]) for _ in range(300)],
        "full": [100] * 40,
        "one length": [33] * 500,
    }[kind]
    df = spark.createDataFrame([(i % 7, n) for i, n in enumerate(lengths)], "doc_id BIGINT, length BIGINT").repartition(5)
    df = df.withColumns({"sequence_id": F.lit("old"), "part": F.lit(1), "_rank": F.lit(2)})
    rows = packing.pack(df, capacity=100).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    bound = -(-sum(lengths) // 100)
    best = {"half": 150 + sum(n == 51 for n in lengths) // 2, "one length": -(-500 // 3)}.get(kind, bound)
    assert check_packing(rows, 100) <= best * 1.02 + 2


def test_packing_refuses_wrong_lengths_and_takes_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id BIGINT, length BIGINT")
    assert packing.pack(empty).count() == 0
    for bad in (0, 2049, None):
        with pytest.raises(Exception, match="not within 1 and 2048"):
            packing.pack(spark.createDataFrame([(1, bad)], "doc_id BIGINT, length BIGINT")).collect()


def test_rounds_depend_on_lengths_not_on_rows():
    few, many = ({n: c * k for n, c in ((5, 300), (700, 40), (1500, 9))} for k in (1, 10_000))
    runs = [packing.Runs(dict(counts), 2048) for counts in (few, many)]
    sizes = [len(r.run()) for r in runs]
    assert runs[1].rounds <= 2 * runs[0].rounds + 10 and sizes[1] <= 4 * sizes[0] + 50


def test_crc_of_pieces(spark):
    row = queries.pieces_of(docs(spark, ["hello"])).select("ids", F.crc32("ids").alias("crc")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))


# --- mixing ---


def test_copies_follow_the_target_shares(spark):
    rows = [(i, "x" * 10, "big" if i % 4 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").withColumn("copy", F.lit("old"))
    mixed = mixing.mix(df, weights={"big": 1.0, None: 3.0}, size=2.0)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert mixed.columns == df.columns
    assert abs(counts["big"] - 3000) < 200 and abs(counts[None] - 9000) < 300
    again = mixing.mix(df, weights={"big": 1.0, None: 3.0}, size=2.0)
    assert sorted(r.doc_id for r in again.collect()) == sorted(r.doc_id for r in mixed.collect())


def test_draws_invert_the_poisson_distribution(spark):
    for mean in (0.0, 0.3, 4.0, 900.0):
        steps = spark.range(1).select(mixing.poisson_steps(F.lit(mean)).alias("s")).first().s
        assert abs(steps[-1] - 1) < 1e-9
        if mean:
            draws = np.random.default_rng(0).random(20_000)
            found = np.searchsorted(np.array(steps), draws, "right")
            assert abs(found.mean() - mean) < 5 * (mean / 20_000) ** 0.5
            assert abs(found.var() - mean) < 0.1 * mean


def test_mixing_odd_rows(spark):
    texts = awkward_texts()
    df = docs(spark, texts)
    mixed = mixing.mix(df, numbers=True)
    assert set(df.columns) - {"copy"} <= set(mixed.columns)
    assert all(r.copy >= 1 for r in mixed.collect())
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [None, ""])).count() == 0
    twice = docs(spark, ["abc"] * 8, ids=[1, 1, 1, 1, None, None, 2, 2])
    counts = {}
    for r in mixing.mix(twice, size=40.0, weights={f"src{k}": 1 for k in range(3)} | {None: 1}).collect():
        counts[r.doc_id, r.source] = counts.get((r.doc_id, r.source), 0) + 1
    assert counts
