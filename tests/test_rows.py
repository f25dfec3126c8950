"""Order-dependent operators against plain loops."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import maintain, rows as ops
from shelfwise.operators import stock as allocation

LIMITED = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def serve_by_loop(lines, supply):
    left, out = dict(supply), {}
    for key, at, asked in sorted(lines, key=lambda r: r[1]):
        fits = 0 < asked <= left.get(key, 100)
        if fits:
            left[key] = left.get(key, 100) - asked
        out[at] = fits
    return out


@LIMITED
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(-1, 9)), min_size=1, max_size=80),
    st.dictionaries(st.sampled_from("ab"), st.integers(0, 40)),
)
def test_allocation_equals_the_loop(spark, lines, supply):
    data = [(1, key, at, asked) for at, (key, asked) in enumerate(lines)]
    orders = spark.createDataFrame(data, "store_id INT, sku STRING, at INT, quantity INT")
    stock = spark.createDataFrame([(1, k, q) for k, q in supply.items()] or [(1, "zz", 0)], "store_id INT, sku STRING, quantity BIGINT")
    got = {r["at"]: r["accepted"] for r in allocation.allocate_stock(stock, orders, ["at"]).collect()}
    assert got == serve_by_loop([(k, at, q) for _, k, at, q in data], supply)


def test_one_hot_key_is_served_in_order(spark):
    draw = random.Random(7)
    lines = [("hot", at, draw.randint(1, 30)) for at in range(3000)]
    orders = spark.createDataFrame(lines, "sku STRING, at INT, quantity INT").withColumn("store_id", F.lit(1))
    stock = spark.createDataFrame([(1, "hot", 500)], "store_id INT, sku STRING, quantity BIGINT")
    got = {r["at"]: r["accepted"] for r in allocation.allocate_stock(stock, orders, ["at"]).collect()}
    assert got == serve_by_loop(lines, {"hot": 500})


def test_keys_on_chunk_edges_are_served_in_order(spark):
    draw = random.Random(8)
    lines = [(draw.choice("abc"), at, draw.choice([1, 2, 5, 40, 0, -3])) for at in range(600)]
    supply = {"a": 70, "b": 10_000, "c": 0}
    data = [(key, at, asked, supply[key]) for key, at, asked in lines] + [(None, 1000 + k, 1, 5) for k in range(40)]
    df = spark.createDataFrame(data, "sku STRING, at INT, quantity INT, available BIGINT").repartition(7)
    for served in (ops.accept_in_order(df, ["sku"], ["at"], "quantity", "available"), by_rounds(df.where("sku IS NOT NULL"))):
        assert served.where("sku IS NULL AND accepted").count() == 0
        got = {r["at"]: (r["accepted"], r["left"]) for r in served.where("sku IS NOT NULL").collect()}
        assert {at: a for at, (a, _) in got.items()} == serve_by_loop(lines, supply)
        assert min(left for a, left in got.values() if a) >= 0 and all(left is None for a, left in got.values() if not a)


def by_rounds(df):
    parts = {"_asked": F.col("quantity").cast("bigint"), "_supply": F.col("available"), "_chunk": (F.col("at") / 37).cast("int")}
    return ops._in_rounds(df.withColumns(parts), ["sku"], ["at"], df.columns)


def test_missing_store_or_sku_is_refused(spark):
    orders = spark.createDataFrame([(None, "a", 1, 1), (1, None, 2, 1), (1, "a", 3, 1)], "store_id INT, sku STRING, at INT, quantity INT")
    stock = spark.createDataFrame([(1, "a", 5)], "store_id INT, sku STRING, quantity BIGINT")
    out = allocation.allocate_stock(stock, orders, ["at"])
    assert {r["at"]: (r["accepted"], r["left"]) for r in out.collect()} == {1: (False, None), 2: (False, None), 3: (True, 4)}


def test_local_stock_counts_when_greater(spark):
    orders = spark.createDataFrame([(1, "a", 1, 60), (1, "b", 2, 60), (1, "c", 3, 60)], "store_id INT, sku STRING, at INT, quantity INT")
    stock = spark.createDataFrame([(1, "a", 5), (1, "b", 5)], "store_id INT, sku STRING, quantity BIGINT")
    local = spark.createDataFrame([(1, "a", 70), (1, "b", 7)], "store_id INT, sku STRING, quantity BIGINT")
    out = allocation.allocate_stock(stock, orders, ["at"], local)
    assert {r["sku"]: r["accepted"] for r in out.collect()} == {"a": True, "b": False, "c": True}


def test_order_lines_merge(spark):
    lines = spark.createDataFrame(
        [("o", "a", 1, 3, 1.0), ("o", "a", 2, 4, 2.0), ("o", "a", 3, 2, 3.0), ("o", "b", 4, 1, 1.0)],
        "order_id STRING, sku STRING, line_no INT, quantity INT, price DOUBLE",
    )
    stock = spark.createDataFrame([("a", 5)], "sku STRING, quantity BIGINT")
    merged, refused = allocation.merge_order_lines(lines, stock)
    assert [tuple(r) for r in merged.collect()] == [("o", "a", 5, 3.0, 2)]
    assert sorted(r.line_no for r in refused.collect()) == [2, 4]


def test_ranks_are_gapless_per_group(spark):
    data = [("big", i) for i in range(500)] + [("small", i) for i in range(7)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "g STRING, v INT").repartition(5)
    got = {(r.g, r.v): r.n for r in ops.ranked(df, ["v"], "n", within=["g"]).collect()}
    assert got == {(g, v): v for g, v in data}
    whole = [r.n for r in ops.ranked(df, ["g", "v"], "n").orderBy("g", "v").collect()]
    assert whole == list(range(507))


@LIMITED
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-20, 20)), min_size=1, max_size=60))
def test_clamped_adjustments_equal_the_loop(spark, changes):
    data = [(1, sku, i, delta) for i, (sku, delta) in enumerate(changes)]
    log = spark.createDataFrame(data, "store_id INT, sku STRING, seq INT, delta INT")
    stock = spark.createDataFrame([(1, "a", 10), (1, "c", 3)], "store_id INT, sku STRING, quantity BIGINT")
    level = 10
    for _, sku, _, delta in data:
        if sku == "a":
            level = max(0, level + delta)
    new, unknown = maintain.adjust_stock(stock, log, ["seq"])
    assert {r.sku: r.quantity for r in new.collect()} == {"a": level, "c": 3}
    assert unknown.count() == sum(sku == "b" for _, sku, _, _ in data)


def changes_by_loop(base, log):
    table, rejects = {k: dict(v) for k, v in base.items()}, []
    for seq, key, op, fields in log:
        if op == "insert":
            if key in table:
                rejects.append((seq, 409))
            else:
                table[key] = dict(fields)
        elif key not in table:
            rejects.append((seq, 404))
        elif op == "delete":
            del table[key]
        else:
            table[key].update({k: v for k, v in fields.items() if v is not None})
    return table, rejects


@LIMITED
@given(
    st.lists(
        st.tuples(
            st.integers(1, 4),
            st.sampled_from(["insert", "update", "delete"]),
            st.one_of(st.none(), st.text("xyz", min_size=1, max_size=2)),
            st.one_of(st.none(), st.integers(0, 9)),
        ),
        min_size=1,
        max_size=50,
    )
)
def test_change_log_equals_the_loop(spark, log):
    base = {1: {"name": "one", "age": 1}, 2: {"name": "two", "age": None}}
    frame = spark.createDataFrame([(k, v["name"], v["age"]) for k, v in base.items()], "id INT, name STRING, age INT")
    steps = [(seq, key, op, {"name": name, "age": age}) for seq, (key, op, name, age) in enumerate(log)]
    changes = spark.createDataFrame(
        [(seq, key, op, f["name"], f["age"]) for seq, key, op, f in steps], "seq INT, id INT, op STRING, name STRING, age INT"
    )
    table, rejects = changes_by_loop(base, steps)
    snapshot, rejected = maintain.apply_changes(frame, changes, "id")
    assert {r.id: {"name": r.name, "age": r.age} for r in snapshot.collect()} == table
    assert sorted((r.seq, r.status) for r in rejected.collect()) == sorted(rejects)


def test_dedup_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k STRING, at INT, v STRING")
    assert {r.k: r.v for r in ops.dedup(df, ["k"], ["at"]).collect()} == {"a": "x", "b": "z"}
    assert {r.k: r.v for r in ops.dedup(df, ["k"], ["at"], "last").collect()} == {"a": "y", "b": "z"}
