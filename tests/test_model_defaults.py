import inspect

import pytest

from terroir.plans import model, testdata


@pytest.mark.parametrize("query", ["forest_metrics", "feature_importance", "forest_predictions", "learning_curve",
                                   "model_actuals", "model_correlation"])
def test_registered_queries_fit_the_original_model(spark, monkeypatch, query):
    class Called(Exception):
        pass

    def run_model(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        raise Called(bound.arguments)

    signature = inspect.signature(model.run_model)
    monkeypatch.setattr(model, "run_model", run_model)
    monkeypatch.setattr(testdata, "feature_frame", lambda spark, d: None)
    with pytest.raises(Called) as call:
        getattr(testdata, query)(spark, "")
    used = call.value.args[0]
    assert (used["num_trees"], used["max_depth"]) == (100, 30)
    assert used["curve_trees"] in (None, 100)
