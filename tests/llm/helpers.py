"""Small tables with every awkward row, and plain versions of the operators."""

import hashlib
import random
import re

LOWER = {i: i + 32 for i in range(65, 91)}

#: Extra columns whose names the operators use inside.
CLASH = ("id", "key", "row", "size", "digest", "part", "rank", "copy", "steps", "of", "node", "class", "n", "group")


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def awkward_texts(seed=3):
    rng = random.Random(seed)
    base = words(rng, 120, 5000)
    near = base.split()
    near[60] = "changed"
    passage = words(rng, 130, 9000)
    return [
        None,
        "",
        "   \n\t ",
        "a",
        "A",
        "two words",
        "Two  WORDS",
        base,
        base,
        base.upper(),
        " ".join(near),
        words(rng, 30) + " " + passage + " " + words(rng, 25),
        words(rng, 20) + " " + passage + " " + words(rng, 40),
        "é" * 500 + " Ünï " + "x" * 700,
        "ab" * 900,
        words(rng, 6000, 100_000),
        "四 " * 300,
        "don't <|endoftext|> 'S 12 <|startoftext|>",
    ]


def docs(spark, texts, ids=None, extra=True):
    rows = [(i if ids is None else ids[i], t, "en", f"src{i % 3}" if i % 5 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(7).alias(c) for c in CLASH))
    return df


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def shingles(text):
    found = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(found) >= 5:
        return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    return frozenset([tuple(found)]) if found else frozenset()


def components(rows, percent=80):
    """{id: (set size, smallest id)} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    head = {i: i for i, _ in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                head[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def repeats(rows, length, keep):
    """{position: (spans, kept bytes)} by listing every string of ``length`` bytes; rows are (id, bytes) in order."""
    seen = {}
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    for k in order:
        data = rows[k][1]
        for p in range(len(data) - length + 1):
            seen.setdefault(data[p : p + length], []).append((k, p))
    out = {}
    for k, (_, data) in enumerate(rows):
        cover = bytearray(len(data))
        for p in range(len(data) - length + 1):
            places = seen[data[p : p + length]]
            if len(places) > 1 and (keep == "none" or places[0] != (k, p)):
                cover[p : p + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", bytes(cover))]
        out[k] = (spans, bytes(b for b, c in zip(data, cover) if not c))
    return out
