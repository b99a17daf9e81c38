"""The driver contract: entry, queries, oracle_sql."""

import __spark_entry__ as E

NO_ORACLE = {
    "arima_forecast",
    "forecast_evaluation",
    "gbt_predict",
    "model_scores",
    "feature_importance",
    "tree_attribution",
    "leafwise_scores",
    "batch_score",
    "prediction_report",
    "evaluation_summary",
    "event_forecast",
    "event_forecast_evaluation",
}


def test_every_oracle_has_a_query_and_vice_versa():
    from tillcast.plans import oracle_sql, registry

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.queries()) - set(oracle_sql.oracle_sql()) == NO_ORACLE


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["branch", "ite_desc_std", "date", "quantity"]
    assert df.count() > 0
    assert E.entry(spark).schema == df.schema


def test_non_oracle_queries_run(spark, sf_small):
    for name in ["arima_forecast", "forecast_evaluation", "batch_score"]:
        assert E.queries()[name](spark, sf_small).count() > 0


def test_the_report_is_on_the_delivered_model(monkeypatch):
    from tillcast.plans import registry

    trained = []
    monkeypatch.setattr(registry, "_trained", lambda spark, sf_dir, params=registry.P: trained.append(params.n_trees) or {"scored": None})
    monkeypatch.setattr(registry.ml, "regression_report", lambda *a: None)
    registry.q_prediction_report(None, "")
    assert trained == [registry.P.n_trees]
