"""The registered boosting queries run the job with its own parameters and cross-validation, once."""

import inspect

from barwise import catalog
from barwise.schemas import MODEL_RUNS


def test_boosting_queries_run_the_whole_job(spark, monkeypatch):
    calls = []
    names, inner = inspect.signature(catalog.MD.train_and_predict), catalog.MD.train_and_predict

    def train(*args, **kw):
        given = names.bind(*args, **kw)
        given.apply_defaults()
        calls.append(given.arguments)
        return inner(*args, **{**kw, "p": catalog.MD.BoostParams(max_iter=2)})
    monkeypatch.setattr(catalog.MD, "train_and_predict", train)
    monkeypatch.setattr(catalog, "_TRAINED", {})
    got = {q: catalog.queries()[q](spark, "/root/testdata/sf0.001") for q in ("gbt_predictions", "gbt_feature_importance", "gbt_folds", "model_run")}
    assert len(calls) == 1 and calls[0]["p"] == catalog.MD.BoostParams() and calls[0]["cv"]
    assert got["gbt_predictions"].count() == 25 and got["gbt_feature_importance"].count() == 49
    assert sorted(r.fold for r in got["gbt_folds"].collect()) == [1, 2, 3]
    row, stats = got["model_run"].first(), catalog.queries()["training_stats"](spark, "/root/testdata/sf0.001").first()
    assert row.n_train_rows + row.n_val_rows == stats.n_rows and (row.train_from, row.val_to) == (stats.min_date, stats.max_date)
    assert row.train_to < row.val_from and got["model_run"].columns == [f.name for f in MODEL_RUNS]
