"""Hard negatives, the Merkle manifest, and SentencePiece encoding and decoding."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import CLASH, awkward_texts, docs, sha
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import merkle, negatives, piececode, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- SentencePiece ---


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_rows_encode_and_decode_like_the_library(spark, library):
    texts = awkward_texts() + ["=" * 3000 + " " * 777, "▁▁ a▁b", " lead and trail  "]
    df = docs(spark, texts)
    coded = piececode.decode(piececode.encode(df, MODEL), MODEL)
    got = {r.doc_id: r for r in coded.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = library.encode(t or "")
        assert got[i].ids == want and got[i].decoded == library.decode(want)
    assert piececode.encode(docs(spark, []), MODEL).count() == 0
    assert [r.ids for r in piececode.encode(docs(spark, ["same", "same"], ids=[1, 1]), MODEL).collect()] == [library.encode("same")] * 2


def test_decoding_keeps_the_other_columns(spark, library):
    rows = [(1, [450, 29871, 13], "x"), (2, None, "y"), (3, [], None), (4, [450, None], "z"), (5, [3, 200, 201, 1, 130, 29871], "w")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, ids ARRAY<INT>, decoded STRING").withColumns({c: F.lit(3) for c in CLASH if c != "id"})
    got = {r.doc_id: r for r in piececode.decode(df, MODEL).collect()}
    assert [got[i].decoded for i in (1, 2, 3, 4)] == [library.decode([450, 29871, 13]), None, "", None]
    assert got[5].decoded == library.decode(rows[4][1]) and got[5].row == 3
    with pytest.raises(Exception, match="not in the vocabulary"):
        piececode.decode(spark.createDataFrame([(1, [32000])], "doc_id BIGINT, ids ARRAY<INT>"), MODEL).collect()


MIXED = st.lists(st.sampled_from(["the", "th", "e", " ", "  ", "▁", "in", "ing", "a", "ab", "é", "四", "\n", "<s>", "<0x0A>", "\0", "😀", "other", "="])).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | MIXED)
def test_any_text_encodes_like_the_library(library, text):
    known = piececode.model(MODEL)
    ids, offsets = known.encode([text, text])
    want = library.encode(text)
    assert ids.tolist() == want * 2 and offsets.tolist() == [0, len(want), 2 * len(want)]
    out, ends = known.decode(ids, offsets)
    assert out[: ends[1]].tobytes().decode() == library.decode(want)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 260) | st.integers(0, 31999) | st.sampled_from([0, 1, 2, 29871]), max_size=12))
def test_any_ids_decode_like_the_library(library, ids):
    out, _ = piececode.model(MODEL).decode(np.array(ids, np.int32), np.array([0, len(ids)]))
    assert out.tobytes().decode() == library.decode(ids)


def test_a_full_memory_of_words_is_emptied(monkeypatch, library):
    monkeypatch.setattr(piececode, "REMEMBERED", 3)
    known = piececode.Model(MODEL)
    for t in ("one two three", "four five six", "one two three", ""):
        assert known.encode([t])[0].tolist() == library.encode(t)
    assert len(known.known) <= 6


# --- Merkle manifest ---


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """By (id, source, lang, n_chars, text) rows: the contract's columns, all trees built level by level."""

    def leaf(row):
        return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def way(tree, place):
        for nodes in tree[:-1]:
            start = place // 3 * 3
            yield nodes[start:place], nodes[place + 1 : start + 3]
            place //= 3

    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in by_source[s]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for place, row in enumerate(by_source[s]):
            steps = [*way(trees[k], place), *way(top, k)]
            odd = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            folded = leaf((*row[:4], row[4].replace("\n", "")) if odd else row)
            for left, right in steps:
                folded = H([*left, folded, *right])
            proof = H(n for left, right in steps for n in left + right)
            out.append((row[0], trees[k][0][place], trees[k][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def manifest_of(df, **how):
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], {"text": text}, **how)


@pytest.mark.parametrize("span", [1, 2, 6])
def test_manifest_equals_the_plain_trees(spark, span):
    rng, texts = random.Random(4), awkward_texts()
    rows = [(i if i % 11 else None, rng.choice(["a", "a", "b", "ä", "", None, f"s{i}"]), rng.choice(["en", None]), rng.choice([None, i]), rng.choice(texts + ["x\ny"])) for i in range(150)]
    rows += [(7, "a", "en", 1, "again\n")] * 40 + [(8, "lone", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING").repartition(5)
    df = df.withColumns({c: F.lit(7) for c in (*CLASH, "hash", "leaf", "tree", "place", "at")})
    got = [tuple(r) for r in manifest_of(df, span=span).collect()]
    assert sorted(got, key=repr) == sorted(plain_manifest(rows), key=repr)


def test_manifest_of_few_rows(spark):
    kinds = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING"
    assert manifest_of(spark.createDataFrame([], kinds)).count() == 0
    for rows in ([(1, None, None, None, None)], [(0, "a", "x", 1, "b\n"), (2, "b", "x", 1, "b\n")]):
        assert sorted(map(tuple, manifest_of(spark.createDataFrame(rows, kinds)).collect())) == sorted(plain_manifest(rows))
    whole = merkle.manifest(spark.createDataFrame([(i, "a", "b\n") for i in range(9)], "doc_id BIGINT, source STRING, text STRING"), ["text"])
    assert whole.where("verified").count() == 9


def test_multiproofs_are_least():
    rng = np.random.default_rng(1)
    for leaves in (1, 2, 3, 4, 10, 27, 28, 100):
        for _ in range(20):
            places = rng.choice(leaves, rng.integers(1, leaves + 1), replace=False)
            got = merkle.missing(places, leaves)
            known = set(places.tolist())
            for width, need in zip(merkle.widths(leaves), got):
                wanted = {q for p in known for q in range(p // 3 * 3, min(p // 3 * 3 + 3, width))} - known
                assert set(need.tolist()) == wanted
                known = {p // 3 for p in known}
            assert known == {0}


# --- hard negatives ---


def plain_mine(rows, k=5, n=10):
    """By (id, label, vector) rows, one an id: all scores of all anchors, sorted."""
    whole = {i: (y, [int(np.floor(256 * float(x))) for x in v]) for i, y, v in rows}
    out = []
    for a, (y, v) in whole.items():
        if a % 100:
            continue
        by = sorted((-sum(p * q for p, q in zip(v, w)), i) for i, (_, w) in whole.items() if i != a)
        positives = [(i, -s) for s, i in by if whole[i][0] == y][:k]
        for i, s in positives:
            found = [(j, -t) for t, j in by if whole[j][0] != y and 30 * s <= -100 * t <= 90 * s][:n]
            out += [(a, i, r + 1, j, s, t) for r, (j, t) in enumerate(found)]
    return sorted(out)


def mined(df):
    return sorted(map(tuple, negatives.mine(df, F.col("id") % 100 == 0, F.col("label")).collect()))


@pytest.mark.parametrize("kind", ["even", "smooth", "ties"])
def test_negatives_equal_all_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(negatives, "LEAST", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    rng = np.random.default_rng(3)
    width = 21 if kind == "smooth" else 64
    v = rng.normal(0, 0.2, (600, width))
    if kind == "smooth":
        v = 0.05 * v + np.repeat(rng.normal(0, 1, (600, 3)), 7, axis=1) + 0.5
    if kind == "ties":
        v = np.round(v[:, :64] * 2) / 2 + 0.25
    rows = [(i, int(y), x.tolist()) for i, (y, x) in enumerate(zip(rng.integers(0, 3, 600) * (rng.random(600) < 0.7), v))]
    df = spark.createDataFrame(rows, "vec_id BIGINT, label INT, embedding ARRAY<DOUBLE>")
    assert mined(df) == plain_mine(rows) != []


def test_negatives_of_odd_rows(spark):
    kinds = "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>"
    assert mined(spark.createDataFrame([], kinds)) == []
    good = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (3, 2, [0.0, 0.0]), (4, 1, [0.0, 0.0]), (100, 3, [1.0, 1.0])]
    bad = [(None, 1, [1.0, 1.0]), (5, None, [1.0, 1.0]), (6, 2, None), (7, 2, [None, 1.0]), (8, 2, [float("nan"), 1.0]), (9, 2, [float("inf"), 1.0]), (10, 2, [1.0]), (11, 2, [])]
    df = spark.createDataFrame(good + bad + good + [(2, 5, [9.0, 9.0])], kinds).withColumns({c: F.lit(9) for c in (*CLASH, "vector", "shard", "asks") if c != "id"})
    want = plain_mine(good)
    assert mined(df.withColumn("id", F.lit(7))) == want and any(r[4] == 0 for r in want)
    with pytest.raises(Exception, match="2\\^53"):
        mined(spark.createDataFrame([(0, 1, [1e9, 1e9])], kinds))


def test_bounds_hold_and_smooth_vectors_are_pruned():
    rng = np.random.default_rng(5)
    v = np.floor(256 * (np.repeat(rng.normal(0, 1, (400, 4)), 16, axis=1) + 0.02 * rng.normal(0, 1, (400, 64))))
    side = object.__new__(negatives.Side)
    side.ids, side.labels, side.vectors = np.arange(400), np.zeros(400), v
    side.means, side.spreads = negatives.summaries(v)
    side.length = np.sqrt((v * v).sum(1))
    exact, last = v @ v.T, None
    for n in range(2):
        low, high = negatives.bounds(side, side, n)
        assert (low <= exact).all() and (exact <= high).all()
        pair = negatives.bounds(side, side, n, (np.arange(400), np.arange(400)))
        assert np.allclose(pair[0], np.diag(low)) and np.allclose(pair[1], np.diag(high))
        assert last is None or (high - low).mean() < last
        last = (high - low).mean()
    seen = [len(left) for _, left, _ in negatives.scores(side.some(slice(0, 20)), side, np.ones((20, 400), bool), lambda a, low, high: high >= negatives._largest(low, 5))]
    assert max(seen) < 200


def test_digests_of_the_queries(spark):
    row = queries.op13_pieces(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").first().text
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = library.encode(text or "")
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
