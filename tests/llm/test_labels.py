"""Language, toxicity, secrets and neighbours: held-out accuracy and plain versions."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from helpers import awkward_texts, docs
from pyspark.sql import functions as F

from shelfwise.llm import langid, neighbours, queries, secrets, toxicity
from shelfwise.llm.common import bounded_sample

SMALL = "/root/testdata/sf0.01"


# --- language ---

STEMS = {"aa": ["lor", "tham", "wick"], "bb": ["ßel", "über", "heit"], "cc": ["ción", "año", "llo"]}


def made_up(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_is_learned(spark):
    rng = random.Random(1)
    rows = [(i, made_up(rng, lang, 20), lang) for i, lang in enumerate(sorted(STEMS) * 60)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING, lang STRING")
    model = langid.fit(df.where("id % 4 <> 2"), langid.Settings(steps=120, rows=50))
    got = {r.id: r for r in langid.predict(df, model, "id").collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, _, lang in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_every_language_is_learned(spark):
    rng = random.Random(2)
    rows = [(10 * k + j, " ".join(f"{chr(0x4E00 + k)}{rng.choice('xyz')}" for _ in range(6)), f"l{k:03}") for k in range(230) for j in range(2 if k < 220 else 1)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING, lang STRING")
    model = langid.fit(df, langid.Settings(steps=2))
    assert len(model.languages) == 230
    assert {r.id for r in langid.predict(df, model, "id").collect()} == {r[0] for r in rows}


def test_language_of_odd_texts(spark):
    rng = random.Random(2)
    model = langid.train([made_up(rng, lang, 30) for lang in STEMS], list(STEMS), langid.Settings(steps=20))
    texts = [*awkward_texts(), "12 34 — !", "\0 1", "x" * 5000]
    got = {r.doc_id: r for r in langid.predict(docs(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        letters = any(map(str.isalpha, t or ""))
        assert (got[i].lang_pred in STEMS) if letters else (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert langid.predict(docs(spark, []), model).count() == 0
    none = langid.fit(spark.createDataFrame([(1, "a", None)], "id BIGINT, text STRING, lang STRING"))
    assert {r.lang_pred for r in langid.predict(docs(spark, texts), none).collect()} == {"und"}


def test_a_text_has_the_mean_of_its_letters():
    """Units once per block and many times in a text give what running over every unit would."""
    rng = random.Random(3)
    texts = [made_up(rng, "aa", 9), made_up(rng, "bb", 5) + " 7 7", "Lor LOR lor"]
    model = langid.train(texts, ["aa", "bb", "cc"], langid.Settings(steps=5))
    raw = [t.encode() for t in texts]
    got = model.predict(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for text, row in zip(texts, got):
        total, letters = np.zeros(3), 0
        for word in re.findall(rb"\S+", text.encode().lower()):
            for at in range(0, len(word), langid.UNIT):
                unit = np.zeros((1, langid.UNIT), np.uint8)
                piece = word[at : at + langid.UNIT]
                unit[0, : len(piece)] = list(piece)
                probs, mask, *_ = langid._forward(model.params, unit)
                total += (probs[:, 0] * mask[:, 0, None]).sum(0)
                letters += mask[:, 0].sum()
        assert np.allclose(row, total / letters, atol=1e-5)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    params = [rng.normal(0, 0.5, s) for s in ((256, 6), (2, 6), (256, 6), (2, 6), (4, 3), (3,))]
    grid = np.zeros((2, langid.UNIT), np.uint8)
    grid[0, :3], grid[1, :2] = list(b"abc"), list(b"ca")

    def loss(ps):
        probs, mask, *_ = langid._forward(ps, grid)
        return -(np.log(probs[:, :, 1]) * mask).sum()

    probs, mask, both, columns, memory, back = langid._forward(params, grid, True)
    error = probs.copy()
    error[:, :, 1] -= 1
    error *= mask[:, :, None]
    outer = error @ params[4].T
    grads = [*langid._layer_back(params[0], params[1], columns, memory, list(outer[:, :, :2]))]
    grads += langid._layer_back(params[2], params[3], columns[::-1], back, list(outer[::-1, :, 2:]))
    for k, place in ((0, (97, 1)), (1, (1, 4)), (2, (99, 5)), (3, (0, 2))):
        up, down = ([p.copy() for p in params] for _ in range(2))
        up[k][place] += 1e-3
        down[k][place] -= 1e-3
        assert abs((loss(up) - loss(down)) / 2e-3 - grads[k][place]) < 2e-2


# --- toxicity ---


def test_toxic_words_and_their_misspellings(spark):
    rng = random.Random(4)
    clean = [" ".join(f"{rng.choice('bdfg')}a{rng.choice('lmnr')}{rng.choice('eiou')}{rng.choice('kpst')}" for _ in range(30)) for _ in range(300)]
    rows = [(i, t + (" you stupidhead fool" if i % 3 == 0 else ""), int(i % 3 == 0)) for i, t in enumerate(clean)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING, label INT")
    model = toxicity.fit(df.where("id % 5 <> 0"))
    got = {r.id: r.score for r in toxicity.score(df, model, "id").collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in held)
    assert model.logits([clean[0] + " stupidheads foool stupidheadd"])[0] > model.logits([clean[0]])[0] + 1


def test_toxicity_of_odd_texts(spark):
    model = toxicity.train(["bad badness " * 3] * 10 + ["good things " * 3] * 30, np.array([1] * 10 + [0] * 30))
    texts = awkward_texts()
    got = toxicity.score(docs(spark, texts), model).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc_id: r.score for r in got}
    assert scores[0] == scores[1] == scores[2]
    df = docs(spark, texts)
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s < 0.5}
    assert toxicity.score(docs(spark, []), model).count() == 0


def test_one_label_gives_its_share(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id BIGINT, text STRING, label INT")
    model = toxicity.fit(rows)
    assert model.logits(["whatever", None])[0] < 0
    assert toxicity.fit(rows.limit(0)).logits([""])[0] < 0


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(1, f"text {i % 40}", i % 2) for i in range(400)] + [(i, f"other {i}", i % 2) for i in range(2, 60)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING, label INT")
    got = bounded_sample(df, {0: 20, 1: 50}, "label").collect()
    assert len({(r.id, r.label) for r in got}) == len(got)
    assert sum(r.label == 0 for r in got) == 20 and sum(r.label for r in got) == 30
    assert {(r.id, r.text, r.label) for r in got} <= set(rows)


def test_training_reads_no_held_out_label(spark):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, None, 1), (None, 1, 1)], "doc_id BIGINT, toxic INT, quality INT")
    rows = toxicity.training_rows(texts, labels, queries.crc_mod(F.col("id"), 5) != 0).collect()
    import zlib

    assert {r.id for r in rows} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5}


# --- secrets ---

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(text):
    found = [("assign", 0, m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", 1, m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", 2, m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(m.start(), rank, m.end(), kind) for kind, rank, m in found]


def secret_texts():
    rng = random.Random(6)
    key = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    plain = ["section2ofthemanual_chapter", "aaaaaaaaaaaaaaaaaaaaaaaaaaa1", "version12345678901234567890", "abcdefghijklmnopqrstuvwx01234"]
    texts = [
        *awkward_texts(),
        "secret: token = abcdefgh",
        "PassWord='hunter22' 😀 api_key=zzzzzz apikey : short",
        "token=token=abcdef12;passwd==x",
        "xAKIAAKIA" + "Q" * 14 + " AKIA" + "B" * 16 + "z",
        "deadbeef" * 3 + "g" + "0" * 23,
        *(f"see {w} here" for w in plain),
        "key " + "Az09" * 9000,
    ]
    random_at = len(texts)
    texts += [f"x {key(mixed, 40)} é {key(mixed, 64)}" for _ in range(80)]
    return texts, random_at


def test_secrets(spark):
    texts, random_at = secret_texts()
    got = {r.doc_id: r for r in secrets.find(docs(spark, texts)).select("*", secrets.written(F.col("base")).alias("text")).collect()}
    for i, t in enumerate(texts):
        wanted = sorted(base_spans(t or ""))
        assert got[i].text == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in wanted)
    found = sum(len(got[i].added) for i in range(random_at, len(texts)))
    assert found >= 0.85 * 160
    assert sum(len(got[i].added) for i in range(random_at)) <= 2
    for i in range(random_at, len(texts)):
        assert all(re.fullmatch("[A-Za-z0-9]+", texts[i][s.start : s.end]) for s in got[i].added)
    assert secrets.find(docs(spark, [])).count() == 0


def test_random_tokens_have_an_even_p(spark):
    rng = np.random.default_rng(8)
    rows = [(rng.integers(0, 62, n).tolist(), 62) for n in (32, 64) for _ in range(600)]
    p = [r.p for r in spark.createDataFrame(rows, "places ARRAY<INT>, size INT").select(secrets.combined("places", "size").alias("p")).collect()]
    assert abs(np.mean(p) - 0.5) < 0.06 and abs(np.mean(np.array(p) < 0.1) - 0.1) < 0.05
    ordered = [(list(range(40)), 62), ([5] * 40, 62), ([0, 61] * 20, 62)]
    p = [r.p for r in spark.createDataFrame(ordered, "places ARRAY<INT>, size INT").select(secrets.combined("places", "size").alias("p")).collect()]
    assert max(p) < 1e-3


def test_few_secrets_of_a_class_are_found(spark):
    few = [("base62/3", p) for p in (0.1, 0.3, 0.7)] + [("lower/2", 0.03), ("base64/0", 0.2)]
    words = [(c, 10 ** -(4.5 + i % 9)) for c in ("lower/2", "base64/0") for i in range(90)]
    even = [("letters/1", np.exp(-1.6 - i / 10)) for i in range(80)] + [("letters/1", 0.9)]
    rows = spark.createDataFrame([(c, float(p)) for c, p in few + words + even], "class STRING, p DOUBLE")
    least = secrets.thresholds(rows, 0.1).collect()[0].least
    assert all(least.get(c, 1) <= p for c, p in few) and least.get("letters/1", 1) > 0.2


WORDS = "get set user name table sales order value index from with query parse report store daily total price list update region".split()
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
ALPHABETS += [ALPHABETS[0] + "0123456789", ALPHABETS[2] + "0123456789", ALPHABETS[2] + "0123456789+/"]


def natural_token(rng, style, n):
    parts = [rng.choice(WORDS) for _ in range(n)]
    if style % 3 == 0:
        parts = ["".join(parts)]
    elif style % 3 == 1:
        parts = ["".join(parts).upper()]
    else:
        parts = [parts[0], *(w.title() for w in parts[1:])]
    if style >= 3:
        parts.insert(rng.randint(1, len(parts)), str(rng.randint(1, 99)))
    return "".join(parts)


def test_rare_secrets_among_natural_tokens(spark):
    rng = random.Random(12)
    plain = {t for style in range(6) for _ in range(120) if len(t := natural_token(rng, style, rng.randint(7, 14))) >= 20}
    hidden = ["".join(rng.choice(a) for _ in range(n)) for a in ALPHABETS for i, n in enumerate((36, 48, 70)) for _ in range(1 + i % 3)]
    texts = [f"say {t} so" for t in [*hidden, *sorted(plain)]]
    got = {r.doc_id: r for r in secrets.find(docs(spark, texts)).collect()}
    found = sum(len(got[i].added) for i in range(len(hidden)))
    false = sum(len(got[i].added) for i in range(len(hidden), len(texts)))
    assert found >= 0.85 * len(hidden) and false <= 0.1 * (found + false), (found, len(hidden), false)


def test_secret_digest(spark, tmp_path):
    texts, _ = secret_texts()
    docs(spark, texts, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op9_secrets(spark, str(tmp_path)).collect():
        spans = sorted(base_spans(texts[r.doc_id] or ""))
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


# --- neighbours ---


def brute_nearest(rows, query, k):
    far = [(float(np.sqrt(((np.array(v) - np.array(query[1])) ** 2).sum())), i) for i, v in rows if i != query[0]]
    return sorted(set(far))[:k]


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=8).round(2).tolist()) for i in range(60)] + [(100 + i, [1.0] * 8) for i in range(20)]
    bad = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [float("inf")] + [1.0] * 7), (204, [None] + [1.0] * 7), (None, [1.0] * 8), (205, [1.0] * 3), (300, [])]
    df = spark.createDataFrame([*good, *bad, good[3]], "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("part", F.lit("x"))
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(got) == {i for i, _ in good if i % 10 == 0}
    for i, v in good:
        if i % 10 == 0:
            assert got[i] == brute_nearest(good, (i, v), 10)


def test_few_rows_and_none(spark):
    kind = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0])], kind)
    got = neighbours.nearest(three, F.col("id") == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 1, 1.0), (2, 2, 2.0)]
    assert neighbours.nearest(three.limit(0), F.col("id") == 0).count() == 0


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 2
    vectors = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = neighbours.nearest(df, F.col("id") % 100 == 0, settings=neighbours.Settings(sample=2048, probes=4, filings=2)).collect()
    hits = 0
    for q in range(0, 4000, 100):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        far[q] = np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(far)[:10].tolist()))
    assert hits >= 0.9 * 400


@pytest.mark.parametrize("parts", [2, 8])
def test_parts_are_balanced_and_follow_the_graph(parts):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(size=(50, 4)) + 20 * k for k in range(8)])
    a, b = neighbours.neighbour_graph(vectors, 5)
    part = neighbours.balanced_parts(400, a, b, parts)
    assert np.bincount(part, minlength=parts).tolist() == [400 // parts] * parts
    assert np.mean(part[a] == part[b]) > 0.95


def test_toxicity_training_holds_its_entries_once(monkeypatch):
    """A sorted copy of the entries, with its order, was held beside them before."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=150)) for _ in range(5000)]
    entries = len(toxicity._weights(texts, 5)[1])
    tracemalloc.start()
    try:
        toxicity.train(texts, np.arange(len(texts)) % 2, toxicity.Settings(epochs=1))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 21 * entries
    monkeypatch.setattr(toxicity, "ENTRIES", 7)
    index, weight = np.array([3, 0, 3, 1] * 5), np.arange(20.0)
    assert np.allclose(toxicity._totals(index, lambda a, b: weight[a:b], 5), np.bincount(index, weight, 5))


def test_toxicity_training_gives_its_memory_back(spark, monkeypatch):
    order, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *a: order.append("train") or train(*a))
    monkeypatch.setattr(toxicity, "give_back", lambda: order.append("give back"))
    rows = spark.createDataFrame([(i, f"some words and {w}", y) for i, (w, y) in enumerate([("mud", 1), ("sun", 0)] * 6)], "id long, text string, label int")
    assert toxicity.fit(rows).logits(["mud", "sun"]).shape == (2,)
    assert "train" in order and order[-1] == "give back"
