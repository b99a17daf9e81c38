"""Named queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.config import FIXTURE, ForecastConfig
from tillcast.operators import (
    clean,
    daily,
    drift,
    forecast,
    layout,
    leafwise,
    ml,
    outliers,
    quality,
    trees,
)
from tillcast.plans import compositions as L
from tillcast.session import checkpoint_dir, materialize, remember_written
from tillcast.sources import files, jdbc
from tillcast.sources.fixtures import load_tables, retail_inputs
from tillcast.sources.schemas import DEPT_MAP_COLUMNS, ITEM_MAP_COLUMNS

P = FIXTURE
Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str):
    return retail_inputs(spark, sf_dir)


def q_clean_transactions(spark, sf_dir):
    return clean.clean_transactions(_inputs(spark, sf_dir).transactions)


def q_source_filter(spark, sf_dir):
    """Source-side projection and predicates (strict date, branch list)."""
    tx = _inputs(spark, sf_dir).transactions
    kept = jdbc.restrict_source(tx, dt.date(P.start_year, 1, 1), ["B1", "B2"])
    return kept.select("data_id", "branch", "ite_code", "quantity", "dep_code", "date", "time", "type")


def q_product_master(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return clean.enrich_products(inp.products, inp.departments, P.null_safe)


def q_dept_prefix(spark, sf_dir):
    return clean.department_prefixes(q_product_master(spark, sf_dir))


def q_dept_overrides(spark, sf_dir):
    return clean.standardize_department(q_product_master(spark, sf_dir), P.override_rules)


def q_item_dept_flags(spark, sf_dir):
    return L.product_master(_inputs(spark, sf_dir), P)


def q_transaction_product_join(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    pm = L.product_master(inp, P)
    return clean.join_transactions(clean.clean_transactions(inp.transactions), pm, P.null_safe)


LAYOUT_BUCKETS = 16


def q_transaction_product_join_bucketed(spark, sf_dir):
    """J4 on stored buckets: neither the transactions nor the catalogue are shuffled by the join."""
    inp = _inputs(spark, sf_dir)
    keys = ["branch", "ite_code", "dep_code"]
    fact = layout.lay_out_fact(clean.clean_transactions(inp.transactions), keys, LAYOUT_BUCKETS, "transactions")
    master = L.product_master(inp, P).withColumnRenamed("incode", "ite_code")
    return layout.join_laid_out(spark, fact, layout.lay_out_lookup(master, keys, fact, "products"))


def q_transaction_master(spark, sf_dir):
    return L.transaction_master(_inputs(spark, sf_dir), P)


def q_daily_quantity(spark, sf_dir):
    return L.daily_quantity(_inputs(spark, sf_dir), P)


def q_branch_item_totals(spark, sf_dir):
    return daily.branch_item_totals(q_daily_quantity(spark, sf_dir), P.start_year, P.end_year)


def q_top_items(spark, sf_dir):
    return daily.top_n_per_group(q_branch_item_totals(spark, sf_dir), P.top_n)


def q_daily_top_items(spark, sf_dir):
    return L.daily_top_items(_inputs(spark, sf_dir), P)


def q_calendar_features(spark, sf_dir):
    return outliers.calendar_features(q_daily_top_items(spark, sf_dir))


def q_iqr_flags(spark, sf_dir):
    return outliers.flag_anomalies(q_daily_top_items(spark, sf_dir), "iqr", k=P.iqr_k, keep_stats=True)


def q_zscore_flags(spark, sf_dir):
    out = outliers.flag_anomalies(q_daily_top_items(spark, sf_dir), "z", k=P.z_k, keep_stats=True)
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


def _daily_top_in_years(spark, sf_dir):
    return daily.year_range(q_daily_top_items(spark, sf_dir), P.start_year, P.end_year)


def q_seasonal_median(spark, sf_dir):
    return outliers.seasonal_median(_daily_top_in_years(spark, sf_dir))


def q_capped_daily(spark, sf_dir):
    return L.capped_daily(_inputs(spark, sf_dir), P)


def _series(spark, sf_dir):
    return L.forecast_series(_inputs(spark, sf_dir), P)


def _horizon():
    return forecast.horizon_for(P.train_end)


def q_forecast_horizon(spark, sf_dir):
    return forecast.horizons(q_clean_transactions(spark, sf_dir))


def q_forecast_calendar(spark, sf_dir):
    return forecast.forecast_calendar(_series(spark, sf_dir), P.train_end, _horizon(), "last_date")


def q_series_keys(spark, sf_dir):
    """The forecast series (distinct keys) with their span and length."""
    return _series(spark, sf_dir).groupBy("branch", "ite_desc_std").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n_days"),
    )


def q_train_test_cut(spark, sf_dir):
    return forecast.train_test_cut(_series(spark, sf_dir), P.train_end, _horizon())


def q_train_test_cut_days(spark, sf_dir):
    """F4 with the day-based test part (end < date <= end + horizon)."""
    return forecast.train_test_cut(_series(spark, sf_dir), P.train_end, _horizon(), eval_mode="days")


def q_lag_features(spark, sf_dir):
    return forecast.lag_features(q_daily_top_items(spark, sf_dir), "quantity", P.lags)


def q_series_difference(spark, sf_dir):
    return forecast.series_difference(_series(spark, sf_dir), "quantity_cap")


def _test_and_typical(spark, sf_dir):
    capped = materialize(L.capped_daily(_inputs(spark, sf_dir), P, years=False), "capped")
    series = capped.select("branch", "ite_desc_std", "date", "quantity_cap")
    test = forecast.train_test_cut(series, P.train_end, _horizon()).where(F.col("part") == "test")
    pred = capped.select("branch", "ite_desc_std", "date", F.col("typical").alias("forecast"))
    return test, pred


def q_forecast_metrics(spark, sf_dir):
    """J7 + A9 with the seasonal median as the prediction (oracle-checkable)."""
    test, pred = _test_and_typical(spark, sf_dir)
    return forecast.forecast_metrics(test, pred, "quantity_cap")


def q_masked_metrics(spark, sf_dir):
    test, pred = _test_and_typical(spark, sf_dir)
    return forecast.masked_metrics(test, pred, "quantity_cap", P.mape_threshold)


FORECAST = ForecastConfig(order=P.arima_order, train_end=P.train_end)


def q_arima_forecast(spark, sf_dir):
    """One ARIMA per (branch, item) series, horizon to the end of next month."""
    series = L.forecast_series(_inputs(spark, sf_dir), P, write=True)  # else AQE may merge the tasks it feeds
    return L.forecasts(series, FORECAST, _horizon())


def q_forecast_evaluation(spark, sf_dir):
    """T4 / L4: ARIMA forecasts scored against the test part."""
    series = L.forecast_series(_inputs(spark, sf_dir), P, write=True)
    return L.forecast_and_evaluate(series, FORECAST)[1]


def q_evaluation_summary(spark, sf_dir):
    """One line per series, MAE and MAPE to two decimals, ordered."""
    return files.evaluation_summary(q_forecast_evaluation(spark, sf_dir))


CERTIFY_GRID = [-0.9, -0.6, -0.3, 0.0, 0.3, 0.6, 0.9]


def q_arima_certificate(spark, sf_dir):
    """Every fitted series against a grid and its neighbours, by the likelihood itself."""
    series = L.forecast_series(_inputs(spark, sf_dir), P, write=True)
    fits = materialize(L.forecasts(series, FORECAST, _horizon()), "fits")
    told = forecast.certify_arma11(series, fits, P.train_end, FORECAST.quant_col, CERTIFY_GRID)
    return told.withColumn("grid_best", F.round("grid_best", 4))


# Given coefficients: the recursion alone, which SQL can follow step by step.
FIXED = (0.4, -0.3)
RANDOM_WALK = ForecastConfig(order=(0, 1, 0), train_end=P.train_end)


def _given(spark, sf_dir, config, coefficients=None):
    series = L.forecast_series(_inputs(spark, sf_dir), P, write=True)
    return L.forecast_and_evaluate(series, config, coefficients)


def _two_decimals(fc):
    return fc.select("branch", "ite_desc_std", "date", F.round("forecast", 2).alias("forecast"), "status")


def q_arima_fixed(spark, sf_dir):
    """ARIMA(1,1,1) with given phi and theta."""
    return _two_decimals(_given(spark, sf_dir, FORECAST, FIXED)[0])


def q_arima_random_walk(spark, sf_dir):
    """T3 with order (0, 1, 0): the last value goes on."""
    return _two_decimals(_given(spark, sf_dir, RANDOM_WALK)[0])


def q_arima_random_walk_evaluation(spark, sf_dir):
    """T4, L4: the random walk scored against the test part."""
    ev = _given(spark, sf_dir, RANDOM_WALK)[1]
    return ev.withColumns({"mae": F.round("mae", 2)})


def q_arima_random_walk_listing(spark, sf_dir):
    """The printed listing, one line a series with MAE and MAPE."""
    return files.evaluation_summary(_given(spark, sf_dir, RANDOM_WALK)[1])


# ---------------------------------------------------------------- files
def _folder(spark, name):
    path = f"{checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"
    remember_written(spark, path)
    return path


def q_csv_mappings(spark, sf_dir):
    """Both mapping tables written as CSV and read back as mappings."""
    inp = _inputs(spark, sf_dir)
    items, depts = _folder(spark, "items"), _folder(spark, "departments")
    for df, columns, path in ((inp.item_map, ITEM_MAP_COLUMNS, items), (inp.dept_map, DEPT_MAP_COLUMNS, depts)):
        whole = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
        files.write_csv(df.select(*whole), path)
    back = files.read_mappings(spark, depts, items)
    rows = back["item"].select(F.lit("item").alias("mapping"), F.col("ite_desc").alias("name"), "cat_flag")
    return rows.unionByName(
        back["department"].select(F.lit("department").alias("mapping"), F.col("dep_desc").alias("name"), "cat_flag")
    )


def q_csv_daily(spark, sf_dir):
    """The daily series written as CSV and read back with typed dates."""
    path = _folder(spark, "daily")
    files.write_csv(q_daily_top_items(spark, sf_dir), path)
    schema = T.StructType.fromDDL("branch string, ite_desc_std string, date date, quantity double")
    return files.read_csv(spark, path, schema)


def q_csv_inferred(spark, sf_dir):
    """The chosen items written as CSV and read back with inferred types."""
    path = _folder(spark, "top")
    files.write_csv(q_top_items(spark, sf_dir), path)
    return files.read_csv(spark, path).withColumn("quantity", F.col("quantity").cast("double"))


def q_daily_head(spark, sf_dir):
    """The first five rows by quantity, branch, item and date."""
    day = q_daily_top_items(spark, sf_dir)
    return day.orderBy(F.col("quantity").desc(), "branch", "ite_desc_std", "date").limit(5)


# ---------------------------------------------------------------- gapless series (events)
EVENT_KEYS = ["event_type"]
EVENT_TRAIN_END = dt.date(2024, 1, 20)


def q_event_daily(spark, sf_dir):
    """A1 on the events table: daily total value per event type (gapless series)."""
    ev = load_tables(spark, sf_dir, ("events",))["events"]
    d = daily.daily_totals(
        ev.select("event_type", F.col("ts").cast("date").alias("date"), "value"),
        keys=("event_type", "date"),
        value="value",
    )
    return d.withColumn("value", F.round("value", 6))


def _event_series(spark, sf_dir):
    return materialize(q_event_daily(spark, sf_dir), "event-series")


def q_event_forecast(spark, sf_dir):
    """T3 on gapless series, where positions and calendar days coincide."""
    h = forecast.horizon_for(EVENT_TRAIN_END)
    return forecast.arima_forecast(
        _event_series(spark, sf_dir), EVENT_TRAIN_END, h, "value", P.arima_order, keys=EVENT_KEYS
    )


def q_event_forecast_evaluation(spark, sf_dir):
    """T4 on the gapless event series."""
    series = _event_series(spark, sf_dir)
    h = forecast.horizon_for(EVENT_TRAIN_END)
    fc = forecast.arima_forecast(series, EVENT_TRAIN_END, h, "value", P.arima_order, keys=EVENT_KEYS)
    test = forecast.train_test_cut(series, EVENT_TRAIN_END, h, keys=EVENT_KEYS).where(F.col("part") == "test")
    return forecast.forecast_metrics(test, forecast.scored_only(fc), "value", keys=EVENT_KEYS)


# ---------------------------------------------------------------- L5: ML path
def _ml_split(spark, sf_dir):
    frame = L.ml_frame(load_tables(spark, sf_dir, ("lineitem", "part")))
    return ml.hash_split(frame, L.ML_KEYS, P.test_fraction, P.seed)


def q_hash_split(spark, sf_dir):
    return _ml_split(spark, sf_dir).select(*L.ML_KEYS, "is_test")


def _encoded(spark, sf_dir):
    split = _ml_split(spark, sf_dir)
    enc = ml.fit_label_encoder(split.where(~F.col("is_test")), L.ML_STRINGS)
    return ml.apply_label_encoder(split, enc, L.ML_STRINGS)


def q_label_encode(spark, sf_dir):
    """Codes fitted on the training part, applied to every row."""
    return _encoded(spark, sf_dir).select(
        *L.ML_KEYS, *L.ML_STRINGS, *[f"{c}_idx" for c in L.ML_STRINGS]
    )


ML_FEATURES = [f"{c}_idx" for c in L.ML_STRINGS] + list(L.ML_NUMBERS)


def _trained(spark, sf_dir, params=P) -> dict:
    """L5 over one input folder."""
    tables = load_tables(spark, sf_dir, ("lineitem", "part"))
    inputs = (tables["lineitem"], tables["part"])
    return L.train_predict_report(L.ml_frame(tables), L.ML_KEYS, L.ML_STRINGS, L.ML_NUMBERS, params, inputs=inputs)


def q_gbt_predict(spark, sf_dir):
    """M3, M4: GBT trained on the training part, one prediction per test row."""
    return _trained(spark, sf_dir)["predictions"]


def q_model_scores(spark, sf_dir):
    """Train and test scores with the model parameters."""
    return _trained(spark, sf_dir)["scores"]


def q_feature_importance(spark, sf_dir):
    """M6: impurity importance and permutation importance (RMSE increase)."""
    t = _trained(spark, sf_dir)
    test = t["data"].where(F.col("is_test")).drop("is_test")
    perm = ml.permutation_importance(t["model"], test, t["features"], L.ML_KEYS, "target", P.seed)
    return ml.feature_importance(t["model"], t["features"]).join(perm, on="feature", how="left")


def q_tree_attribution(spark, sf_dir):
    """M6: additive attribution of the boosted model's predictions over all training rows."""
    t = _trained(spark, sf_dir)
    ensemble = trees.ensemble_of_gbt(t["model"], t["features"], _folder(spark, "trees"))
    train = t["data"].where(~F.col("is_test")).select(*t["features"])
    attributed = trees.attribute(ensemble, trees.same_paths(ensemble, train))
    return trees.attribution_summary(attributed, t["features"], count="n_rows")


# Two given trees over quantity, size and line number, with the rows that reached each node.
GIVEN_FEATURES = ["l_quantity", "p_size", "l_linenumber"]
GIVEN_TREES = [
    trees.Node(0, 1, 0, 24.0, 2, 3, 0.0, 1000.0),
    trees.Node(0, 2, 1, 10.0, 4, 5, 0.0, 480.0),
    trees.Node(0, 3, 2, 3.0, 6, 7, 0.0, 520.0),
    trees.Node(0, 4, -1, 0.0, -1, -1, 1000.0, 100.0),
    trees.Node(0, 5, -1, 0.0, -1, -1, 2000.0, 380.0),
    trees.Node(0, 6, -1, 0.0, -1, -1, 4000.0, 300.0),
    trees.Node(0, 7, 0, 40.0, 14, 15, 0.0, 220.0),
    trees.Node(0, 14, -1, 0.0, -1, -1, 5000.0, 120.0),
    trees.Node(0, 15, -1, 0.0, -1, -1, 7000.0, 100.0),
    trees.Node(1, 1, 1, 25.0, 2, 3, 0.0, 1000.0),
    trees.Node(1, 2, -1, 0.0, -1, -1, -500.0, 500.0),
    trees.Node(1, 3, 0, 10.0, 6, 7, 0.0, 500.0),
    trees.Node(1, 6, -1, 0.0, -1, -1, 250.0, 90.0),
    trees.Node(1, 7, -1, 0.0, -1, -1, 900.0, 410.0),
]


def _given_frame(spark, sf_dir):
    return L.ml_frame(load_tables(spark, sf_dir, ("lineitem", "part")))


def q_tree_attribution_fixed(spark, sf_dir):
    """M6 for given trees: every row's parts, which SQL finds by all coalitions."""
    rows = _given_frame(spark, sf_dir).select(*L.ML_KEYS, "l_quantity", "p_size")
    told = trees.attribute(trees.Ensemble(GIVEN_FEATURES, GIVEN_TREES), rows)
    values = ["prediction", "base", *[f"part_{f}" for f in GIVEN_FEATURES]]
    return told.select(*L.ML_KEYS, *[F.round(v, 6).alias(v) for v in values])


ONE_TREE = leafwise.LeafwiseParams(n_trees=1, learning_rate=0.5, max_leaves=3, max_depth=2, min_rows=20, l2=1.0)
FIVES = {c: [float(v) for v in range(5, 50, 5)] for c in ("l_quantity", "p_size")}


def q_leafwise_tree(spark, sf_dir):
    """M3: the nodes of one leaf-wise tree with given bins."""
    grown = leafwise.train_leafwise(_given_frame(spark, sf_dir), list(FIVES), "target", ONE_TREE, FIVES)
    nodes = grown.frame(spark).where("tree >= 0")
    names = F.array(*[F.lit(f) for f in FIVES])
    split = F.col("feature") >= 0
    return nodes.select(
        "node",
        F.when(split, F.element_at(names, F.col("feature") + 1)).alias("feature"),
        F.when(split, F.round("threshold", 6)).alias("threshold"),
        F.when(split, F.round(F.sqrt(F.col("gain") / F.col("cover")), 4)).alias("gain"),
        F.when(~split, F.round("value", 6)).alias("value"),
        F.col("cover").cast("long").alias("cover"),
    )


LEAFWISE = leafwise.LeafwiseParams(n_trees=10, learning_rate=0.3)


def q_leafwise_scores(spark, sf_dir):
    """M3-M5 with the leaf-wise learner (ten trees): scores of both parts."""
    data, features = L.encoded_frame(_given_frame(spark, sf_dir), L.ML_KEYS, L.ML_STRINGS, L.ML_NUMBERS, P)
    ensemble = leafwise.train_leafwise(data.where(~F.col("is_test")), features, "target", LEAFWISE)
    scored = trees.predict(ensemble, data).withColumn("dataset", F.when(F.col("is_test"), "test").otherwise("train"))
    return ml.regression_scores(scored, "target", "dataset")


FEW_TREES = dataclasses.replace(P, n_trees=5)


def q_prediction_counts(spark, sf_dir):
    """M2-M4: rows and predictions of each part, for a model of few trees."""
    scored = _trained(spark, sf_dir, FEW_TREES)["scored"]
    return scored.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"), F.count("prediction").alias("n_predictions"))


def q_prediction_report(spark, sf_dir):
    """The quality report on the model's own predictions."""
    scored = _trained(spark, sf_dir)["scored"]
    return ml.regression_report(scored, "target", "prediction")


def _report_frame(spark, sf_dir):
    capped = L.capped_daily(_inputs(spark, sf_dir), P, years=False)
    return capped.withColumn(
        "dataset",
        F.when(F.col("date") <= F.lit(P.train_end), "reference").otherwise("current"),
    )


def q_regression_report(spark, sf_dir):
    """A11, A12 on the seasonal median as the prediction of daily quantity."""
    return ml.regression_report(_report_frame(spark, sf_dir), "quantity", "typical")


def q_column_drift(spark, sf_dir):
    """How the columns after the training period differ from those before."""
    capped = _report_frame(spark, sf_dir).withColumn("gap", F.when(F.col("anomaly"), F.col("quantity") - F.col("typical")))
    numbers = ["quantity", "quantity_cap", "gap", "month", "dayofweek"]
    told = drift.column_drift(capped.withColumn("dayofweek", F.weekday("date")), numbers, ["branch", "ite_desc_std"])
    return told.withColumns({"ks": F.round("ks", 6), "psi": F.round("psi", 6)})


def q_error_histogram(spark, sf_dir):
    return ml.error_histogram(_report_frame(spark, sf_dir), "quantity", "typical", -50.0, 50.0, 20)


def q_batch_score(spark, sf_dir):
    """M7, M8: classifier fitted on the training part of the embeddings and
    saved; the latest version is loaded and scores every row."""
    emb = load_tables(spark, sf_dir, ("embeddings",))["embeddings"]
    width = len(emb.select("embedding").first()[0])
    split = ml.hash_split(emb, ["vec_id"], P.test_fraction, P.seed)
    root = ml.model_root(spark, uuid.uuid4().hex)
    ml.save_version(ml.train_classifier(split.where(~F.col("is_test")), "embedding", width), root)
    return ml.score_latest(root, emb, "embedding", width, ["vec_id"])


def fixed_weights(classes: int = 5, width: int = 64) -> list[list[float]]:
    return [[float((c * 7 + i * 3) % 11 - 5) for i in range(width)] for c in range(classes)]


def q_batch_score_fixed(spark, sf_dir):
    """M8 with given weights, which SQL can follow."""
    emb = load_tables(spark, sf_dir, ("embeddings",))["embeddings"]
    return ml.linear_classes(emb, "embedding", fixed_weights(), ["vec_id"])


# ---------------------------------------------------------------- quality
def q_dup_keys(spark, sf_dir):
    return quality.duplicate_keys(q_item_dept_flags(spark, sf_dir))


def q_dept_key_repeats(spark, sf_dir):
    """D3: department keys with several rows (J1 fans out on them; A6 collapses
    the repeats whose name is the same)."""
    depts = _inputs(spark, sf_dir).departments
    return quality.duplicate_keys(depts, keys=("branch", "dept_code"), detail="dept_name")


def q_unmatched_depts(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return quality.unmatched_departments(L.product_master(inp, P), inp.dept_map)


QUERIES: dict[str, Query] = {
    "clean_transactions": q_clean_transactions,
    "source_filter": q_source_filter,
    "product_master": q_product_master,
    "dept_prefix": q_dept_prefix,
    "dept_overrides": q_dept_overrides,
    "item_dept_flags": q_item_dept_flags,
    "transaction_product_join": q_transaction_product_join,
    "transaction_product_join_bucketed": q_transaction_product_join_bucketed,
    "transaction_master": q_transaction_master,
    "daily_quantity": q_daily_quantity,
    "branch_item_totals": q_branch_item_totals,
    "top_items": q_top_items,
    "daily_top_items": q_daily_top_items,
    "calendar_features": q_calendar_features,
    "iqr_flags": q_iqr_flags,
    "zscore_flags": q_zscore_flags,
    "seasonal_median": q_seasonal_median,
    "capped_daily": q_capped_daily,
    "forecast_horizon": q_forecast_horizon,
    "forecast_calendar": q_forecast_calendar,
    "series_keys": q_series_keys,
    "train_test_cut": q_train_test_cut,
    "train_test_cut_days": q_train_test_cut_days,
    "lag_features": q_lag_features,
    "series_difference": q_series_difference,
    "forecast_metrics": q_forecast_metrics,
    "masked_metrics": q_masked_metrics,
    "arima_forecast": q_arima_forecast,
    "forecast_evaluation": q_forecast_evaluation,
    "evaluation_summary": q_evaluation_summary,
    "arima_certificate": q_arima_certificate,
    "arima_fixed": q_arima_fixed,
    "arima_random_walk": q_arima_random_walk,
    "arima_random_walk_evaluation": q_arima_random_walk_evaluation,
    "arima_random_walk_listing": q_arima_random_walk_listing,
    "csv_mappings": q_csv_mappings,
    "csv_daily": q_csv_daily,
    "csv_inferred": q_csv_inferred,
    "daily_head": q_daily_head,
    "event_daily": q_event_daily,
    "event_forecast": q_event_forecast,
    "event_forecast_evaluation": q_event_forecast_evaluation,
    "hash_split": q_hash_split,
    "label_encode": q_label_encode,
    "gbt_predict": q_gbt_predict,
    "model_scores": q_model_scores,
    "feature_importance": q_feature_importance,
    "tree_attribution": q_tree_attribution,
    "tree_attribution_fixed": q_tree_attribution_fixed,
    "leafwise_tree": q_leafwise_tree,
    "leafwise_scores": q_leafwise_scores,
    "prediction_counts": q_prediction_counts,
    "prediction_report": q_prediction_report,
    "regression_report": q_regression_report,
    "error_histogram": q_error_histogram,
    "column_drift": q_column_drift,
    "batch_score": q_batch_score,
    "batch_score_fixed": q_batch_score_fixed,
    "dup_keys": q_dup_keys,
    "dept_key_repeats": q_dept_key_repeats,
    "unmatched_depts": q_unmatched_depts,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
