"""The registered model queries run the full settings, not a smaller job."""

import pytest
from pyspark.sql import functions as F

from strata.operators import models
from strata.plans.catalog import QUERIES, modelling

SF_DIR = "/root/testdata/sf0.001"
FULL = [(name, grid, 3, {}) for name, grid in models.GRIDS.items()]


@pytest.fixture
def fits(monkeypatch):
    """What every ``train_one`` is asked for; a small tree stands in for the fit."""
    asked, fit = [], modelling.training.train_one

    def record(data, name, grid=None, folds=3, seed=42, parallelism=4, **params):
        asked.append((name, grid, folds, params))
        if not grid:
            return fit(data, "DecisionTree", maxDepth=1)
        return fit(data, name, **{k: 1 for k in grid if k != "stepSize"})

    monkeypatch.setattr(modelling.training, "train_one", record)
    return asked


@pytest.mark.parametrize("name", ["cv_grid", "best_params"])
def test_grids_are_searched_whole(spark, fits, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert fits == FULL
    assert {r["run_id" if name == "cv_grid" else "model"] for r in rows} == set(models.GRIDS)


@pytest.mark.parametrize("query,name", [("rf_fit", "RandomForest"), ("gbt_fit", "GBT"), ("mlp_fit", "MLP")])
def test_single_fits_have_default_sizes(spark, fits, query, name):
    QUERIES[query](spark, SF_DIR)
    assert fits == [(name, None, 3, {})]


def test_comparison_holds_all_models(spark, fits):
    rows = QUERIES["train_and_compare"](spark, SF_DIR).collect()
    names = ["DecisionTree", "LogisticRegression", "RandomForest", "GBT", "MLP"]
    assert sorted(r["model"] for r in rows) == sorted(names) and [f[0] for f in fits] == names
    assert [f for f in fits if f[0] in models.GRIDS] == FULL and all(f[3] == {} for f in fits)


def test_folds_and_fractions(spark, monkeypatch):
    asked = {}

    def folds(df, stages, k, label):
        asked["folds"] = (k, df.select("fold").distinct().count(), stages[-1].getMaxIter(), stages[-1].getMaxDepth())
        return df.select(F.lit(1))

    def curve(train, validation, stages, fractions, label, key):
        asked["curve"] = (fractions, stages[-1].getNumTrees(), stages[-1].getMaxDepth())
        return train.select(F.lit(1))

    monkeypatch.setattr(models, "kfold_scores", folds)
    monkeypatch.setattr(models, "learning_curve", curve)
    QUERIES["kfold_scores"](spark, SF_DIR)
    QUERIES["learning_curve"](spark, SF_DIR)
    assert asked == {"folds": (5, 5, 20, 5), "curve": ([0.1, 0.3, 0.5, 0.7, 1.0], 20, 5)}
