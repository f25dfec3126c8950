"""The pipeline's stages on awkward rows, and the whole pipeline stage by stage against plain versions."""

import random

import pytest
from helpers import LOWER, awkward_texts, components, docs, words

import corpus_pipeline
from shelfwise.llm import queries
from shelfwise.llm.common import stage

STEPS = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean and toxic texts with labels, exact and near copies, and odd rows."""
    path, rng = tmp_path_factory.mktemp("corpus"), random.Random(9)
    texts = awkward_texts()
    for k in range(120):
        text = words(rng, 40, 3000)
        texts.append(text + " vile scumbag wretch" if k % 4 == 0 else text)
    labels = [(i, 1, int(k % 4 == 0)) for k, i in enumerate(range(len(texts) - 120, len(texts))) if k % 7]
    base = words(rng, 80, 9000).split()
    for k in range(10):
        base[k * 7] = f"edit{k}"
        texts += [" ".join(base), " ".join(base).upper()]
    df = docs(spark, texts, extra=False).selectExpr("*", "cast(length(text) as bigint) AS n_chars")
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{path}/labels.parquet")
    return str(path), texts


def test_stages_take_effect(spark, folder):
    path, texts = folder
    df = spark.read.parquet(f"{path}/documents.parquet")
    columns = df.columns

    def apply(name):
        out = stage(STEPS[name](spark, df, path), "stage")
        if name != "packing":
            assert out.columns == columns
        return out

    df = apply("toxicity")
    kept = {r.doc_id for r in df.collect()}
    toxic = {i for i, t in enumerate(texts) if "scumbag" in (t or "")}
    assert not kept & toxic and len(kept) >= len(texts) - len(toxic) - 2

    df = apply("exact dedup")
    groups = {}
    for i in kept:
        groups.setdefault((texts[i] or "").translate(LOWER), []).append(i)
    kept = {r.doc_id for r in df.collect()}
    assert kept == {max(ids) for ids in groups.values()}

    df = apply("n-gram jaccard join")
    wanted = {c for _, c in components([(i, texts[i]) for i in sorted(kept)]).values()}
    kept = [r.doc_id for r in df.collect()]
    assert sorted(kept) == sorted(wanted)

    df = apply("mixing")
    assert {r.doc_id for r in df.collect()} <= wanted
    copies = df.count()
    rows = apply("packing").collect()
    assert len([r for r in rows if r.piece == 0]) == copies
    ends = {}
    for r in rows:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 2048


def test_run_equals_its_stages_in_kind(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_stages_take_empty_tables(spark, folder):
    path, _ = folder
    none = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, none, path).count() == 0


def test_stages_take_nulls_repeats_and_clashing_columns(spark, folder):
    path, _ = folder
    odd = docs(spark, ["same", "same", None, "x y z", None], ids=[1, 1, None, None, 5])
    for name, step in corpus_pipeline.STAGES:
        rows = step(spark, odd, path).collect()
        assert name == "mixing" or rows


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)
