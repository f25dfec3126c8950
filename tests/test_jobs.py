"""Models, streams, sinks and plans."""

import datetime as dt
import math
import random
import uuid
from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.operators import aggregate, boosting, clean, dims, features, lookup, model
from shelfwise.plans import forecast, training
from shelfwise.plans import features as jobs
from shelfwise.session import OWN_SCRATCH, scratch_dir, stage
from shelfwise.sources import tables as io
from shelfwise.streaming import audit, runs, sales
from shelfwise.streaming import stock as stocks


def folder(spark):
    return f"{scratch_dir(spark)}/test-{uuid.uuid4().hex}"


@pytest.fixture(scope="session")
def base(spark, small):
    from registry.tables import tables

    return tables(spark, small, "transactions", "products", "stores", "requests")


@pytest.fixture(scope="session")
def table(spark, base):
    return stage(jobs.flagship_features(base, extended=True), "features")


@pytest.fixture(scope="session")
def fitted(spark, base, table):
    tx = base["transactions"].withColumn("sku", F.trim("sku"))
    return training.train_demand(training.training_set(table, tx))


def test_lazy_and_staged_features_agree(base, table):
    lazy = jobs.flagship_features(base, extended=True, staging=jobs.lazily)
    assert lazy.exceptAll(table).count() == 0 and table.exceptAll(lazy).count() == 0


def test_transactions_are_scanned_once(spark, base):
    path = folder(spark)
    for name in ("transactions", "products", "stores"):
        base[name].write.parquet(f"{path}/{name}")
    scans = []

    def spy(df, label):
        scans.append(any("/transactions/" in file for file in df.inputFiles()))
        return stage(df, label)

    tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("transactions", "products", "stores")}
    out = jobs.flagship_features(tables, staging=spy)
    assert sum(scans) == 1 and not any("/transactions/" in file for file in out.inputFiles())


def test_an_empty_feature_table_is_an_error(table):
    assert io.require_snapshot(table).select("date").distinct().count() == 1
    with pytest.raises(ValueError, match="no valid dates"):
        io.require_snapshot(table.where("false"))


def test_scratch_needs_a_named_folder():
    app = SimpleNamespace(applicationId="app-1")
    for key in ("spark.checkpoint.dir", OWN_SCRATCH):
        assert scratch_dir(SimpleNamespace(conf={key: "/shared/"}, sparkContext=app)) == "/shared/app-1"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(SimpleNamespace(conf={}))


def test_model_beats_nothing_and_survives_saving(spark, table, fitted):
    trained, metrics = fitted
    row = metrics.first()
    assert row.n > 0 and row.rmse > 0 and row.mae <= row.rmse
    path = folder(spark)
    model.save_model(trained, path)
    again = model.load_model(spark, path)
    assert again.inputs == trained.inputs
    rows = model.calendar_features(table)
    a = model.score(trained, rows).select("store_id", "sku", "date", F.round("prediction", 6).alias("p"))
    b = model.score(again, rows).select("store_id", "sku", "date", F.round("prediction", 6).alias("p"))
    assert a.exceptAll(b).count() == 0
    assert a.where("p < 0 OR p IS NULL").count() == 0


def test_a_broken_save_leaves_the_last_model(spark, table, fitted, monkeypatch):
    path = folder(spark)
    with pytest.raises(FileNotFoundError, match="no complete model"):
        model.load_model(spark, path)
    first = model.save_model(fitted[0], path)

    class Breaks:
        def save(self, where):
            raise OSError("disk full")

    with pytest.raises(OSError):
        model.save_model(model.DemandModel("tweedie", fitted[0].encoder, fitted[0].scaler, fitted[0].inputs, Breaks()), path)
    assert model.newest_version(spark, path) == first and model.load_model(spark, path).inputs == fitted[0].inputs
    second = model.save_model(fitted[0], path)
    assert second != first and model.newest_version(spark, path) == second
    assert model.load_model(spark, first).regression.intercept == fitted[0].regression.intercept


def frame_of(spark, rows):
    return spark.createDataFrame([(float(y), Vectors.dense(x)) for y, *x in rows], ["qty", "features"])


def test_a_round_is_a_newton_step(spark):
    rows = [(y, x) for x, ys in ((0.0, (0, 1, 3)), (1.0, (4, 8, 0))) for y in ys for _ in range(10)]
    df = frame_of(spark, rows)
    fit = boosting.boost(df, df, trees=1, rate=0.5, patience=5)
    mean = sum(y for y, _ in rows) / len(rows)
    got = {r.features[0]: r.prediction for r in fit.transform(df).collect()}
    for x in (0.0, 1.0):
        ys = [y for y, at in rows if at == x]
        step = sum(y * mean**-0.5 - mean**0.5 for y in ys) / sum(0.5 * mean**0.5 + 0.5 * y * mean**-0.5 for y in ys)
        assert got[x] == pytest.approx(mean * math.exp(0.5 * step))
    assert (fit.grown, fit.best) == (1, 1)


def test_boosting_stops_by_patience_and_is_cut_at_the_best_round(spark):
    draw = random.Random(3)
    part = [[(draw.choice([0, 0, 1, 2 + 6 * (x > 0.5)]), x, draw.random()) for x in (draw.random() for _ in range(400))] for _ in range(2)]
    train, valid = (frame_of(spark, rows).coalesce(1) for rows in part)
    fit = boosting.boost(train, valid, trees=40, rate=0.4, patience=3, depth=3)
    assert fit.best == 1 + fit.losses.index(min(fit.losses)) and fit.grown in (fit.best + 3, 40)
    assert fit.trees.getNumTrees == fit.best and fit.losses[0] > min(fit.losses)
    scored = fit.transform(valid)
    assert boosting.mean_loss(scored, "qty", F.log("prediction")) == pytest.approx(min(fit.losses))
    path = folder(spark)
    fit.save(path)
    again = boosting.BoostedTrees.load(path)
    assert again.transform(valid).select("prediction").exceptAll(scored.select("prediction")).count() == 0
    assert (again.grown, again.best, again.losses) == (fit.grown, fit.best, fit.losses)


def test_daily_forecast_replaces_weeks(spark, table, fitted):
    path, parts = folder(spark), ["forecast_year", "forecast_week", "model_version"]
    out = forecast.run_forecast(table, fitted[0], dt.date(2026, 12, 28))
    assert {(r.forecast_year, r.forecast_week) for r in out.collect()} == {(2026, 53), (2027, 53), (2027, 1)}
    io.replace_partitions_at(out, path, parts)
    io.replace_partitions_at(out, path, parts)
    assert spark.read.parquet(path).count() == out.count()


def test_batch_reports_every_request(base, table, fitted):
    out = forecast.score_batch(base["requests"], table, base["products"], base["stores"], fitted[0])
    assert out.count() == base["requests"].count()
    counts = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert counts["success"] > 0 and counts["error"] > 0
    assert out.where((F.col("status") == "error") & (F.col("predicted_quantity") != 0)).count() == 0


def test_unseen_labels_get_code_zero(spark):
    known = spark.createDataFrame([("b",), ("a",), (None,)], "city STRING")
    encoder = model.fit_encoder(known, ["city"])
    out = model.encode(spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "city STRING"), encoder, ["city"])
    # "None" stands for a missing text and sorts before lower-case letters.
    assert sorted((str(r.city), r.city_code) for r in out.collect()) == [("None", 0), ("a", 1), ("b", 2), ("zz", 0)]


def test_exact_split_has_the_wanted_size(spark):
    df = spark.range(100).select(
        F.lit(1).alias("store_id"), F.col("id").cast("string").alias("sku"), F.expr("date_add(DATE '2024-01-01', cast(id div 50 AS INT))").alias("date")
    )
    assert [part.count() for part in model.time_split(df, 0.8, exact=True)] == [80, 20]
    assert [part.count() for part in model.time_split(df, 0.8)] == [50, 50]


def test_feature_sink_replaces_dates(spark, table):
    path = folder(spark)
    days = [r.date for r in table.select("date").distinct().orderBy("date").limit(4).collect()]
    some = table.where(F.col("date").isin(days))
    io.write_features(some, [{"path": path}])
    io.write_features(some.where(F.col("date") == days[0]), [{"path": path}])
    assert spark.read.parquet(path).count() == some.count()


def test_jdbc_scans_must_be_split(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        io.read_table(spark, "jdbc:x", "t", "jdbc", {"user": "u"})


# --- streams over several files, stopped and started again ---


def write_slices(spark, path, parts, schema):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)


def test_stock_stream_equals_batch_after_restart(spark):
    src, out = folder(spark), folder(spark)
    kind = "store_id INT, sku STRING, quantity BIGINT"
    opening = spark.createDataFrame([(1, "a", 5), (1, "c", 1)], kind)
    write_slices(spark, src, [[(1, "a", -2), (1, "b", 4)]], kind)

    def run():
        changes = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
        stocks.stock_stream(changes, f"{out}/batches", f"{out}/checkpoint").awaitTermination()
        rows = stocks.on_hand(spark, f"{out}/batches", opening).collect()
        return {r.sku: (r.quantity, r.warn) for r in rows}

    assert run() == {"a": (3, False), "b": (4, False), "c": (1, False)}
    write_slices(spark, src, [[(1, "a", -4)], [(1, "b", -4), (1, "a", 0)]], kind)
    assert run() == {"a": (-1, True), "b": (0, False), "c": (1, False)}


def test_duplicate_sales_arrive_once(spark):
    src, out = folder(spark), folder(spark)
    kind = "transaction_id STRING, transaction_date TIMESTAMP"
    at = dt.datetime(2024, 1, 1, 10)
    write_slices(spark, src, [[("x", at), ("y", at)], [("x", at), ("z", at)]], kind)
    tx = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
    sales.dedup_stream(tx, f"{out}/rows", f"{out}/c").awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{out}/rows").collect()) == ["x", "y", "z"]


@pytest.mark.parametrize("fold_every", [100, 2])
def test_late_sales_are_never_lost(spark, fold_every):
    src, out = folder(spark), folder(spark)
    kind = "transaction_id STRING, store_id INT, sku STRING, quantity INT, transaction_date TIMESTAMP"
    rows = [[(name, 1, "a", 2, dt.datetime(2024, 1, day))] for name, day in (("a", 1), ("b", 10), ("c", 11), ("z", 2))]
    write_slices(spark, src, [*rows, [("z", 1, "a", 2, dt.datetime(2024, 1, 2)), ("y", 1, "a", -1, dt.datetime(2024, 1, 2))]], kind)

    def tx():
        return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)

    sales.dedup_stream(tx(), f"{out}/rows", f"{out}/c1").awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{out}/rows").collect()) == ["a", "b", "c", "y", "z"]
    sales.daily_stream(tx(), f"{out}/days", f"{out}/c2", refreshed=f"{out}/new", fold_every=fold_every).awaitTermination()
    got = sales.days(spark, f"{out}/days").orderBy("date").collect()
    assert [(r.date.day, r.qty) for r in got] == [(1, 2.0), (2, 4.0), (10, 2.0), (11, 2.0)]
    fresh = sales.newest_features(spark, f"{out}/new").orderBy("date").collect()
    assert [(r.date.day, r.lag_1d, r.total_lifespan) for r in fresh] == [(1, 0.0, 0.0), (2, 2.0, 1.0), (10, 4.0, 9.0), (11, 2.0, 10.0)]


def test_late_audit_events_count(spark):
    src, out = folder(spark), folder(spark)
    kind = "timestamp TIMESTAMP, action STRING"
    hours = [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 3, 10), dt.datetime(2024, 1, 1, 10, 30)]
    write_slices(spark, src, [[(hour, "USER_LOGIN")] for hour in hours], kind)
    log = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
    audit.audit_stream(log, f"{out}/n", f"{out}/c").awaitTermination()
    assert sorted(r.n for r in audit.counts(spark, f"{out}/n").collect()) == [1, 2]


def test_runs_cover_all_batches_once():
    for every in (2, 3, 8):
        for n in range(200):
            got = runs.cover(n, every)
            assert [b for size, first in got for b in range(first, first + size)] == list(range(n))
            assert len(got) <= (every - 1) * (1 + sum(every**k <= n for k in range(1, 9)))


def test_reading_cost_is_flat_and_late_rows_rewrite_little(spark, monkeypatch):
    src, out = folder(spark), folder(spark)
    kind = "transaction_id STRING, store_id INT, sku STRING, quantity INT, transaction_date TIMESTAMP"
    batches = [[(f"t{n}{s}", s, "a", 1 + n % 3, dt.datetime(2024, 1, 1) + dt.timedelta(n)) for s in (1, 2)] for n in range(8)]
    batches.append([("late", 2, "a", 5, dt.datetime(2024, 1, 7)), ("t31", 1, "a", 9, dt.datetime(2024, 1, 4))])
    write_slices(spark, src, batches, kind)
    opened, read = [], runs.read

    def spy(spark, path, schema, which=None, buckets=None):
        if buckets is not None:
            opened.append((path, len(which), len(buckets)))
        return read(spark, path, schema, which, buckets)

    monkeypatch.setattr(runs, "read", spy)

    def tx():
        return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(src)

    sales.dedup_stream(tx(), f"{out}/rows", f"{out}/c1", fold_every=2, buckets=4).awaitTermination()
    sales.daily_stream(tx(), f"{out}/days", f"{out}/c2", refreshed=f"{out}/new", fold_every=2, buckets=4).awaitTermination()
    assert len(opened) == 18 and max(n for _, n, _ in opened) <= 4 and max(b for _, _, b in opened) <= 2
    ids = sorted(r.transaction_id for r in spark.read.parquet(f"{out}/rows").collect())
    assert ids == sorted({r[0] for b in batches for r in b}) and len(ids) == 17
    rewritten = spark.read.parquet(runs.folder(f"{out}/new/rows", 1, 8))
    assert sorted((r.store_id, r.date.day) for r in rewritten.collect()) == [(1, d) for d in range(4, 9)] + [(2, d) for d in range(7, 9)]
    whole = features.window_features(sales.days(spark, f"{out}/days"), extended=True)
    whole = features.lifespan(whole, features.series_table(whole))
    got = sales.newest_features(spark, f"{out}/new")
    assert got.count() == 16 and got.select(*whole.columns).exceptAll(whole).count() == 0


def test_readers_wait_for_a_run_to_be_complete(spark):
    path, kind = folder(spark), "store_id INT, sku STRING, net BIGINT"
    for batch in range(4):
        runs.write(spark.createDataFrame([(1, "a", 1)], kind), path, batch, kind, runs.adding(["store_id", "sku"]), 2)
    assert runs.written(spark, path) == [(2, 0), (1, 2), (1, 3)]
    runs.write(spark.createDataFrame([(1, "a", 1)], kind), path, 4, kind, runs.adding(["store_id", "sku"]), 2)
    assert runs.written(spark, path) == [(4, 0), (1, 4)] == runs.cover(4, 2) + [(1, 4)]
    assert [r.net for r in runs.adding(["store_id", "sku"])(runs.read(spark, path, kind)).collect()] == [5]
    assert runs.written(spark, f"{path}/none") == [] and runs.read(spark, f"{path}/none", kind).count() == 0


def test_refresh_touches_only_late_series(spark):
    daily = spark.createDataFrame(
        [(1, s, dt.date(2024, 1, d), float(d)) for s in "ab" for d in (1, 2, 3)], "store_id INT, sku STRING, date DATE, qty DOUBLE"
    )
    late = daily.where("sku = 'a' AND date = '2024-01-02'")
    got = sales.refresh_features(late, daily).orderBy("date").collect()
    assert [(r.sku, r.date.day, r.lag_1d) for r in got] == [("a", 2, 1.0), ("a", 3, 2.0)]


def test_sliding_audit_counts(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 40), "USER_LOGIN")], "timestamp TIMESTAMP, action STRING")
    assert audit.audit_counts(log, "1 hour", "30 minutes").count() == 2


# --- plans ---


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_share_one_shuffle_and_sort(spark, table):
    daily = table.select("store_id", "sku", "date", F.col("lag_1d").alias("qty"))
    text = plan(features.window_features(daily, extended=True))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("+- Sort") == 1


def test_no_nested_loops(spark, table, base):
    keys = table.select("store_id", "sku", "date")
    products = spark.createDataFrame([(1, "a", "x")], "product_id INT, sku STRING, product_name STRING")
    inventory = spark.createDataFrame([("a", "x", 1)], "sku STRING, product_name STRING, stock_quantity INT")
    for df in (lookup.nearest_features(keys, table), dims.product_stock(products, inventory)):
        assert "NestedLoop" not in plan(df) and "CartesianProduct" not in plan(df)


def test_filters_reach_the_scan(spark):
    from shelfwise.operators.clean import clean_transactions

    path = folder(spark)
    spark.createDataFrame(
        [(1, "a", 2.0, 0.1, dt.datetime(2024, 1, 1), "unused")],
        "store_id INT, sku STRING, quantity DOUBLE, discount_pct DOUBLE, transaction_date TIMESTAMP, note STRING",
    ).write.parquet(path)
    text = plan(clean_transactions(spark.read.parquet(path)).select("store_id", "quantity"))
    assert "GreaterThan(quantity,0.0)" in text
    assert "note" not in text.split("ReadSchema")[1]


def test_arriving_files_stay_small_as_the_table_grows(spark, small, monkeypatch):
    from registry import files

    monkeypatch.setattr(files, "FILE_ROWS", 20, raising=False)
    key = F.col("event_id")
    path, source = folder(spark), folder(spark)
    spark.range(0, 100).select(F.col("id").alias("event_id")).write.parquet(f"{source}/events.parquet")
    seen = []
    arriving = files.stream(spark, source, "events", "event_id")
    arriving.writeStream.option("checkpointLocation", path).foreachBatch(
        lambda batch, _: seen.append([r.n for r in batch.groupBy(F.input_file_name()).agg(F.count(key).alias("n")).collect()])
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and sum(map(sum, seen)) == 100
    # Two files a trigger for 100 rows; before, a file was a third of any table.
    assert all(len(sizes) == 2 for sizes in seen) and max(map(max, seen)) < 30


def test_requests_are_staged_narrow_and_once(spark, base, table, monkeypatch):
    """Wide rows of requests were staged before, and the requests themselves computed three times."""
    kept = {}

    def spy(df, label="frame"):
        kept.setdefault(label, []).append(df.columns)
        return stage(df, label)

    for module in (forecast, lookup):
        monkeypatch.setattr(module, "stage", spy)
    checked, bad = forecast.prepared_requests(base["requests"], table, base["products"], base["stores"])
    assert checked.count() + bad.count() == base["requests"].count()
    assert len(kept["requests"]) == 1 and "lag_1d" not in kept["requests"][0]
    assert all("lag_1d" not in columns for frames in kept.values() for columns in frames)


def test_requests_are_computed_once_for_their_features(spark, base, table):
    """The requests were derived a second time for the last join."""
    parsed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    day = table.agg(F.max("date")).first()[0]
    asked = table.where(F.col("date") == F.lit(day)).select("store_id", "sku", "date")
    counted = asked.mapInArrow(count, asked.schema)
    got = lookup.features_for(counted, table, base["products"], base["stores"]).collect()
    assert {r.source for r in got} == {"daily"} and parsed.value == len(got)


def test_undated_requests_find_what_is_known_of_product_and_store(spark, base, table):
    day = table.agg(F.max("date")).first()[0]
    store, sku = table.where(F.col("date") == F.lit(day)).select("store_id", "sku").first()
    kind = "store_id INT, sku STRING, date DATE, lag_1d DOUBLE"
    asked = spark.createDataFrame([(store, sku, None, 1.0), (store, sku, day, 2.0), (store, sku, day, 3.0), (store, None, day, 4.0), (99, "none", None, 5.0)], kind)
    got = lookup.features_for(asked, table, base["products"], base["stores"]).collect()
    assert {r.asked_lag_1d: r.source for r in got} == {1.0: "static", 2.0: "daily", 3.0: "daily", 4.0: "missing", 5.0: "missing"}
    assert len(got) == 5 and {r.feature_date for r in got if r.source == "daily"} == {day}


def test_a_boosting_round_evaluates_its_own_tree_only(spark, monkeypatch):
    """Each pass of a round evaluated all trees since the last staging before."""
    sizes, ensemble = [], boosting._ensemble

    def spy(trees, rate):
        sizes.append(len(trees))
        return ensemble(trees, rate)

    monkeypatch.setattr(boosting, "_ensemble", spy)
    rows = [(Vectors.dense([float(i % 7), float(i % 3)]), float(i % 7 + i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, ["features", "qty"])
    fit = boosting.boost(df, df, trees=4, rate=0.5, patience=5, depth=2)
    assert sizes == [1, 1, 1, 1, fit.best]
    assert boosting.mean_loss(fit.transform(df), "qty", F.log("prediction")) == pytest.approx(min(fit.losses))
