"""Split, label encoder, GBT, scores, report, versions, batch scoring."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions import metrics as M
from tillcast.operators import ml


@pytest.fixture(scope="module")
def frame(spark):
    """The synthetic frame of the original unit tests: 150 daily rows from
    2023-01-01, four uniform features and a uniform target, seed 42."""
    rng = np.random.default_rng(42)
    x = rng.random((150, 4))
    y = rng.random(150)
    rows = [
        (dt.date(2023, 1, 1) + dt.timedelta(days=i), *map(float, x[i]), float(y[i]))
        for i in range(150)
    ]
    return spark.createDataFrame(
        rows, "ts date, feature1 double, feature2 double, feature3 double, feature4 double, target double"
    )


FEATURES = ["feature1", "feature2", "feature3", "feature4"]


def test_frame_has_target(frame):
    assert "target" in frame.columns
    ml.require_target(frame)
    with pytest.raises(ValueError):
        ml.require_target(frame.drop("target"))


def test_split_covers_every_row_once(frame):
    s = ml.hash_split(frame, ["ts"])
    n_train = s.where(~F.col("is_test")).count()
    n_test = s.where(F.col("is_test")).count()
    assert n_train + n_test == frame.count() and 10 < n_test < 50
    assert s.where(F.col("is_test")).collect() == ml.hash_split(frame, ["ts"]).where(F.col("is_test")).collect()


def test_label_encoder_sorted_codes_null_category(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x"), ("a", "y"), (None, "y")], "s string, t string")
    enc = ml.fit_label_encoder(df, ["s", "t"])
    codes = {(r.column, r.value): r.code for r in enc.collect()}
    # 'None' sorts after capitals and before lower case, as in a byte-wise sort
    assert codes == {("s", "None"): 0, ("s", "a"): 1, ("s", "b"): 2, ("s", "c"): 3,
                     ("t", "None"): 0, ("t", "x"): 1, ("t", "y"): 2}
    new = spark.createDataFrame([("z", "x"), (None, None)], "s string, t string")
    out = ml.apply_label_encoder(new, enc, ["s", "t"]).orderBy("s").collect()
    assert [(r.s_idx, r.t_idx) for r in out] == [(0, 0), (-1, 1)]


def test_label_encoder_many_partitions(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 1000).cast("string").alias("v")).repartition(13)
    enc = ml.fit_label_encoder(df, ["v"]).collect()
    got = sorted((r.value, r.code) for r in enc)
    want = [(v, i) for i, v in enumerate(sorted({str(i * 7919 % 1000) for i in range(3000)}))]
    assert got == want


def test_gbt_one_prediction_per_test_row(frame):
    s = ml.hash_split(frame, ["ts"])
    model = ml.train_gbt(s.where(~F.col("is_test")), FEATURES, n_trees=5)
    test = s.where(F.col("is_test"))
    pred = ml.predict(model, test, ["ts"])
    assert pred.count() == test.count()
    assert pred.where(F.col("prediction").isNull()).count() == 0
    imp = ml.feature_importance(model, FEATURES).collect()
    assert [r.feature for r in imp] == FEATURES and abs(sum(r.importance for r in imp) - 1) < 1e-9


def test_unknown_algorithm():
    with pytest.raises(ValueError):
        ml.gbt_pipeline(FEATURES, algorithm="svm")


def test_r2_matches_definition(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "target double, prediction double")
    r = ml.regression_scores(df).first()
    y, p = np.array([1.0, 2, 4]), np.array([1.5, 2, 3])
    assert abs(r.r2 - (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-12


def test_report_and_histogram(spark):
    df = spark.createDataFrame(
        [("reference", 1.0, 1.5), ("reference", 2.0, 2.0), ("current", 4.0, 30.0), ("current", 4.0, -99.0)],
        "dataset string, y double, p double",
    )
    rep = {r.dataset: r for r in ml.regression_report(df, "y", "p").collect()}
    assert rep["reference"].n == 2 and rep["reference"].mae == 0.25
    hist = {(r.dataset, r.bin): r.n for r in ml.error_histogram(df, "y", "p", -50, 50, 20).collect()}
    assert hist[("current", 0)] == 1 and hist[("current", 16)] == 1 and hist[("reference", 11)] == 2


def test_model_versions(spark, frame, tmp_path):
    model = ml.train_gbt(frame, FEATURES, n_trees=2)
    root = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        ml.load_latest(root)
    assert ml.save_version(model, root).endswith("v=0")
    assert ml.save_version(model, root).endswith("v=1")
    loaded = ml.load_latest(root)
    a = [r.prediction for r in model.transform(frame).orderBy("ts").collect()]
    b = [r.prediction for r in loaded.transform(frame).orderBy("ts").collect()]
    assert a == b


def test_batch_score_ints_and_width_check(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=4) + (i % 2) * 3], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    model = ml.train_classifier(df, "embedding", 4)
    out = ml.batch_score(model, df, "embedding", 4, ["vec_id"])
    assert dict(out.dtypes)["prediction"] == "int"
    res = {r.vec_id: r.prediction for r in out.collect()}
    assert len(res) == 60 and sum(res[i] == i % 2 for i in res) >= 55
    bad = spark.createDataFrame([(1, [1.0, 2.0], 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="must have 4 values"):
        ml.batch_score(model, bad, "embedding", 4, ["vec_id"]).collect()


def test_permutation_importance_finds_the_signal(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), float(10 * a)) for i, (a, b) in enumerate(rng.random((400, 2)))]
    df = spark.createDataFrame(rows, "k long, a double, b double, target double")
    model = ml.train_gbt(df, ["a", "b"], n_trees=10)
    imp = {r.feature: r.rmse_increase for r in ml.permutation_importance(model, df, ["a", "b"], ["k"]).collect()}
    assert imp["a"] > 1.0 and abs(imp["b"]) < 0.2


def test_l5_composition(spark, frame):
    from tillcast.config import RunParams
    from tillcast.plans.compositions import train_predict_report

    framed = frame.withColumn("cat", F.when(F.col("feature1") > 0.5, "hi").otherwise("lo"))
    out = train_predict_report(framed, ["ts"], ["cat"], ["feature2"], RunParams(n_trees=3))
    n_test = ml.hash_split(framed, ["ts"]).where(F.col("is_test")).count()
    assert out["predictions"].count() == n_test
    assert {r.dataset for r in out["scores"].collect()} == {"train", "test"}
    report = ml.regression_report(out["scored"], "target", "prediction", "dataset")
    assert {r.dataset for r in report.collect()} == {"train", "test"}


def test_batch_score_matches_numpy_on_small_fixture(spark, sf_small):
    """Scores from the Spark job equal argmax(W x + b) computed directly."""
    emb = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    width = len(emb.first().embedding)
    model = ml.train_classifier(emb, "embedding", width, max_iter=20)
    lr = model.stages[-1]
    W = lr.coefficientMatrix.toArray()
    b = lr.interceptVector.toArray()
    got = {r.vec_id: r.prediction for r in ml.batch_score(model, emb, "embedding", width, ["vec_id"]).collect()}
    rows = emb.collect()
    X = np.array([np.array(r.embedding, dtype=float) for r in rows])
    want = dict(zip([r.vec_id for r in rows], np.argmax(X @ W.T + b, axis=1).tolist()))
    assert got == want


def test_exact_quantiles_match_numpy_across_partitions(spark):
    rng = np.random.default_rng(12)
    a = rng.normal(size=2000)
    b = rng.integers(0, 5, size=7).astype(float)  # ties and a tiny group
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r.g, r.p): r.quantile for r in ml.exact_quantiles(df, "v", "g", probs).collect()}
    for g, vals in [("a", a), ("b", b)]:
        for p in probs:
            assert abs(got[(g, p)] - np.quantile(vals, p)) < 1e-12, (g, p)


def test_r2_of_large_targets(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    y = 1e9 + rng.normal(size=500) * 2
    p = y + 0.5 * np.sign(rng.normal(size=500))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    got = df.agg(M.r2(F.col("y"), F.col("p"))).first()[0]
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert abs(got - want) < 1e-9


def test_quantile_tasks_stay_even_on_ties(spark):
    from tillcast.session import materialize

    df = spark.range(40_000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 5 < 4, 0.0).otherwise(F.col("id").cast("double")).alias("v")
    )
    got = {r.p: r.quantile for r in ml.exact_quantiles(df, "v", "g", [0.5, 0.9]).collect()}
    import numpy as np

    want = np.quantile([r.v for r in df.collect()], [0.5, 0.9])
    assert np.allclose([got[0.5], got[0.9]], want)
    counted = materialize(df.groupBy("g", "v").count().repartitionByRange(8, "g", "v").withColumn("t", F.spark_partition_id()), "ties")
    sizes = [r["n"] for r in counted.groupBy("t").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_algorithms_differ():
    params = [tuple(sorted(ml.ALGORITHMS[a].items())) for a in ml.ALGORITHMS]
    assert len(set(params)) == len(params)


def test_scoring_survives_drop_of_written_tables(spark, sf_small):
    from tillcast.plans import registry
    from tillcast.session import drop_materialized

    registry.q_prediction_counts(spark, sf_small).collect()
    drop_materialized(spark)
    assert registry.q_prediction_counts(spark, sf_small).count() == 2


class _Written:
    """A model whose saving can be watched or broken off."""

    def __init__(self, model, during=lambda: None):
        self.model, self.during = model, during

    def write(self):
        return self

    def save(self, path):
        self.model.write().save(path)
        self.during()


@pytest.fixture(scope="module")
def small_model(frame):
    return ml.train_gbt(frame.withColumnRenamed("target", "t"), FEATURES, "t", n_trees=1)


def test_a_half_written_version_is_never_loaded(spark, small_model, tmp_path):
    root = str(tmp_path / "models")
    first = ml.save_version(small_model, root)

    def die():
        raise RuntimeError("saver lost")

    with pytest.raises(RuntimeError):
        ml.save_version(_Written(small_model, die), root)
    # moved into place, but its saver died before publishing
    (tmp_path / "models" / "v=1").mkdir()
    (tmp_path / "models" / "_claims" / "v=1").touch()
    assert ml.latest_version(root) == 0 and ml.load_latest(root).stages
    seen = []
    path = ml.save_version(_Written(small_model, lambda: seen.append(ml.latest_version(root))), root)
    assert seen == [0] and (first[-3:], path[-3:]) == ("v=0", "v=2") and ml.latest_version(root) == 2


def test_concurrent_savers_get_versions_of_their_own(spark, small_model, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    root, together = str(tmp_path / "models"), Barrier(4)
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(lambda _: ml.save_version(_Written(small_model, together.wait), root), range(4)))
    assert sorted(p[-3:] for p in paths) == ["v=0", "v=1", "v=2", "v=3"] and ml.latest_version(root) == 3
    for p in paths:
        assert ml.PipelineModel.load(p).stages[-1].getNumTrees == 1


def test_fitted_once_for_the_same_files_and_parameters(spark, small_model, frame, tmp_path):
    path, fits = str(tmp_path / "in"), []
    frame.write.parquet(path)

    def fit():
        fits.append(1)
        return small_model

    name = lambda *p: "test-" + ml.fingerprint([spark.read.parquet(path)], *p)
    for parameters in ((1,), (1,), (2,)):
        assert ml.fitted_once(name(*parameters), fit).stages
    assert len(fits) == 2
    frame.limit(3).write.mode("append").parquet(path)
    ml.fitted_once(name(1), fit)
    assert len(fits) == 3


def test_equal_bins_are_trained_on_as_one_cell(spark, monkeypatch):
    """The learner gets one weighted row a cell, and its model is that of all rows."""
    from pyspark.ml.feature import Bucketizer

    rows = spark.range(6000).select(
        (F.col("id") % 6).cast("double").alias("a"), (F.col("id") * 7919 % 11).cast("double").alias("b"),
        (F.col("id") * 31 % 97).cast("double").alias("noise"),
    ).withColumn("target", F.col("a") * F.col("b") + F.col("noise"))
    seen = []
    fit = ml.Pipeline.fit
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    model = ml.train_gbt(rows, ["a", "b"], n_trees=4)
    assert seen == [66] and isinstance(model.stages[0], Bucketizer)
    plain = fit(ml.gbt_pipeline(["a", "b"], n_trees=4), rows)
    both = model.transform(rows).select("a", "b", F.col("prediction").alias("p")).distinct().join(
        plain.transform(rows).select("a", "b", F.col("prediction").alias("q")).distinct(), ["a", "b"]
    ).collect()
    assert len(both) == 66 and all(abs(r.p - r.q) < 1e-6 for r in both)


def test_cells_keep_the_smallest_leaf_in_rows(spark):
    """Twenty rows a leaf are twenty rows, not twenty cells."""
    df = spark.range(400).select((F.col("id") % 4).cast("double").alias("a"), (F.col("id") % 4 * 10).cast("double").alias("target"))
    model = ml.train_gbt(df, ["a"], algorithm="lightgbm", n_trees=1)
    assert model.stages[-1].trees[0].numNodes > 1
    few = ml.train_gbt(df.limit(30), ["a"], algorithm="lightgbm", n_trees=1)
    assert few.stages[-1].trees[0].numNodes == 1


def test_missing_and_constant_features(spark):
    nan = float("nan")
    rows = [(float(i % 3) if i % 5 else nan, 7.0, None if i % 7 == 0 else 1.0, float(i % 3 if i % 5 else 9)) for i in range(210)]
    df = spark.createDataFrame(rows, "a double, b double, c double, target double")
    model = ml.train_gbt(df, ["a", "b", "c"], n_trees=30)
    told = model.transform(df).select("target", "prediction").collect()
    assert len(told) == 210 and max(abs(r.target - r.prediction) for r in told) < 0.5
    with pytest.raises(Exception, match="must not be null"):
        ml.train_gbt(df.withColumn("target", F.lit(None).cast("double")), ["a"], n_trees=1)


def test_few_codes_are_not_dealt_by_value(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, "N").otherwise("R").alias("s"))
    out = ml.apply_label_encoder(df, ml.fit_label_encoder(df, ["s"]), ["s"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert {(r.s, r.s_idx) for r in out.collect()} == {("N", 0), ("R", 1)}
