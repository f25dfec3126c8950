"""Exact deduplication, the Jaccard join and repeated passages against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import CLASH, LOWER, awkward_texts, components, docs, repeats, sha, words

from shelfwise.llm import exactdup, simjoin, suffixdup


def brute_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    return {t: (max(ids), len(ids)) for t, ids in groups.items()}


def test_exact_groups_equal_brute_force(spark):
    texts = awkward_texts()
    df = docs(spark, texts)
    got = {r.doc_id: r for r in exactdup.exact_groups(df, digests="all").collect()}
    groups = brute_groups(enumerate(texts))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        folded = (t or "").translate(LOWER)
        keep, size = groups[folded]
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].digest) == (keep, size, i == keep, sha(folded))
    shared = exactdup.exact_groups(df).collect()
    assert {r.doc_id for r in shared} == {i for i, t in enumerate(texts) if groups[(t or "").translate(LOWER)][1] > 1}


def test_repeated_rows_and_null_ids_keep_one(spark):
    df = docs(spark, ["Same", "same", "same", "other", "SAME"], ids=[5, 9, 9, 1, None])
    got = exactdup.exact_groups(df, digests="all").collect()
    assert sum(r.kept for r in got if r.group_size == 4) == 1
    assert {r.keep_id for r in got} == {9, 1}
    assert sorted((r.doc_id, r.text) for r in exactdup.keep_one(df).collect()) == [(1, "other"), (9, "same")]


def test_keep_one_returns_all_columns(spark):
    texts = awkward_texts()
    df = docs(spark, texts)
    kept = exactdup.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {v[0] for v in brute_groups(enumerate(texts)).values()}


def test_jaccard_components_equal_brute_force(spark):
    rng = random.Random(11)
    texts = awkward_texts()
    # A chain of near copies whose ends do not link, copies that share a passage only, and repeated words.
    chain = words(rng, 100, 10_000).split()
    for k in range(12):
        chain = list(chain)
        chain[(k * 8) % 100] = f"edit{k}"
        texts.append(" ".join(chain))
    for n in range(1, 12):
        texts += [words(rng, n, 3) for _ in range(3)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in simjoin.components(docs(spark, texts)).collect()}
    assert got == components(list(enumerate(texts)))


@pytest.mark.parametrize("short", [1, 128])
def test_jaccard_in_small_parts(spark, monkeypatch, short):
    monkeypatch.setattr(simjoin, "SHORT", short)
    monkeypatch.setattr(simjoin, "LONG", 4)
    monkeypatch.setattr(simjoin, "PAIRS", 50)
    monkeypatch.setattr(simjoin, "PART", 3)
    monkeypatch.setattr(simjoin, "QUERIES", 2)
    rng = random.Random(5)
    base = words(rng, 60, 10_000).split()
    texts = []
    for k in range(40):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(60)] = f"edit{k}{rng.randrange(99)}"
        texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in simjoin.components(docs(spark, texts)).collect()}
    assert got == components(list(enumerate(texts)))


@pytest.mark.parametrize("short", [4, 128])
def test_jaccard_on_pages_of_a_template(spark, monkeypatch, short):
    """Pages that overlap by 0.6 to 0.8 and mostly do not link, with near copies of some, in short and in long lists."""
    monkeypatch.setattr(simjoin, "SHORT", short)
    monkeypatch.setattr(simjoin, "LONG", 8)
    monkeypatch.setattr(simjoin, "PART", 16)
    rng = random.Random(23)
    frame = words(rng, 120, 10_000).split()
    texts = [" ".join([*frame, *(f"own{k}w{i}" for i in range(rng.randrange(10, 28)))]) for k in range(150)]
    for k in range(0, 150, 6):
        copy = texts[k].split()
        copy[rng.randrange(120, len(copy))] = f"edit{k}"
        texts += [" ".join(copy), " ".join([*copy, "more"])]
    wanted = components(list(enumerate(texts)))
    assert 20 < len({c for _, c in wanted.values()}) < 150
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in simjoin.components(docs(spark, texts)).collect()}
    assert got == wanted


def test_jaccard_opens_a_group_by_its_stored_union():
    """The bound lets a query through that the union of a group fills, and none that it cannot; groups of one are compared there."""
    numbers = {name: np.array(sorted(tokens), np.uint64) for name, tokens in {"a": range(100), "b": range(5, 105), "fits": range(10, 110), "far": range(50, 150)}.items()}

    def pairs(rows):
        run, _ = simjoin._bound(80)
        table = pa.table({"group": [r[0] for r in rows], "part": [0] * len(rows), "asks": [r[1] for r in rows], "node": pa.array([r[2] for r in rows], pa.int64()), "tokens": [numbers[r[3]].tobytes() for r in rows]})
        return [tuple(r.values()) for batch in run(iter(table.to_batches())) for r in batch.to_pylist()]

    assert pairs([(1, False, None, "a"), (1, False, None, "b"), (1, True, 7, "fits"), (1, True, 8, "far")]) == [(7, 1, False)]
    assert pairs([(1, False, 1, "a"), (1, True, 7, "fits"), (1, True, 9, "b"), (1, True, 8, "far")]) == [(7, 1, True), (9, 1, True)]


def test_jaccard_joins_leave_the_sets_in_place(spark):
    df = docs(spark, [words(random.Random(k), 60) for k in range(9)], extra=False)
    rows = df.select(df.doc_id.alias("id"), "text")
    nodes = rows.mapInArrow(simjoin._whole_sets, "node long, tokens binary").select("node")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = simjoin._sets(rows, rows.select("id").crossJoin(nodes), "tokens")
        joined = sets.join(nodes, "node")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == sets.count() == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Only the narrow side is moved.
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_jaccard_keeps_one_of_a_group(spark):
    texts = awkward_texts()
    df = docs(spark, texts)
    kept = simjoin.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in components(list(enumerate(texts))).values()}


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [1, 2000])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, keep, hot):
    monkeypatch.setattr(suffixdup, "HOT", hot)
    rng = random.Random(2)
    texts = awkward_texts()[:15]
    passage = words(rng, 60, 10**6)
    texts += [words(rng, rng.randrange(1, 30), 10**6) + passage[: rng.randrange(150, 400)] + words(rng, 20, 10**6) for _ in range(12)]
    texts += [passage + passage, "q" * 300, "ab" * 70 + passage]
    rows = [(i, (t or "").encode()) for i, t in enumerate(texts)]
    wanted = repeats(rows, 200, keep)
    got = suffixdup.remove_repeats(docs(spark, texts), 200, keep).collect()
    assert len(got) == len(texts)
    for r in got:
        spans, kept = wanted[r.doc_id]
        assert (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) == (len(rows[r.doc_id][1]), spans, kept)


def test_long_texts_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixdup, "BLOCK", 1000)
    rng = random.Random(4)
    passage = words(rng, 40, 10**6)
    texts = [words(rng, 600, 10**6) + passage + words(rng, 500, 10**6), passage]
    wanted = repeats([(i, t.encode()) for i, t in enumerate(texts)], 200, "none")
    for r in suffixdup.remove_repeats(docs(spark, texts), 200, "none").collect():
        assert [(s.start, s.end) for s in r.spans] == wanted[r.doc_id][0]


def test_suffix_order_and_previous_factors():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    order = suffixdup.SuffixOrder(data, np.arange(250), 40)
    text = bytes(data) + bytes(48)
    assert [text[s : s + 40] for s in order.suffixes] == sorted(text[s : s + 40] for s in range(250))
    factors = dict(zip(order.suffixes, suffixdup.previous_factors(order, order.suffixes)))

    def common(a, b):
        n = 0
        while n < 40 and text[a + n] == text[b + n]:
            n += 1
        return n

    for p in range(250):
        assert factors[p] == max((common(p, q) for q in range(p)), default=0)


def test_empty_tables(spark):
    none = docs(spark, [])
    for df in (exactdup.exact_groups(none, digests="all"), exactdup.keep_one(none), simjoin.components(none), suffixdup.remove_repeats(none)):
        assert df.count() == 0
    assert set(CLASH) <= set(exactdup.keep_one(none).columns)
