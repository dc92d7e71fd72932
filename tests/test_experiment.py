"""End-to-end modelling runs: regular sampling, season holdout, balanced training."""

import pytest

from playlab.plans.experiment import experiment
from playlab.sources.plays import plays

from conftest import SF001

CATS = ["season_type", "posteam", "week", "season", "roof", "surface"]
NUMS = ["quarter_seconds_remaining", "down", "ydstogo", "ep", "wind", "temp"]


@pytest.mark.parametrize("kind,grid,balanced,holdout,refit", [
    ("nb", {"smoothing": [0.5, 1.0]}, False, None, False),
    ("nb", {"smoothing": [0.5, 1.0]}, False, None, True),
    ("lr", {"regParam": [0.0, 0.1], "maxIter": [10]}, False, 2001, False),
    ("rf", {"numTrees": [5], "maxDepth": [3]}, True, None, False),
])
def test_experiment(spark, kind, grid, balanced, holdout, refit):
    ex = experiment(plays(spark, SF001), kind, grid, CATS, NUMS, balanced=balanced, holdout=holdout,
                    refit_features=refit)
    rows = {r.frame: r for r in ex.report.collect()}
    assert set(rows) == ({"test", "holdout"} if holdout else {"test"})
    for r in rows.values():
        assert 0.0 <= r.accuracy <= 1.0
    n_test = ex.scored["test"].count()
    assert ex.confusion.where("frame = 'test'").groupBy().sum("n").first()[0] == n_test
    assert len(ex.tuned.metrics) == len(ex.tuned.param_maps)
