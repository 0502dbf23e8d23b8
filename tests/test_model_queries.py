import pytest

from sigspark.plans import model_queries as mq
from sigspark.plans import models


def test_registered_searches_use_the_full_grids():
    lr, svm = models.logistic_grid(), models.svm_grid()
    assert len(lr.settings) == 10 and lr.max_iter == 1000
    assert len(svm.settings) == 5 and svm.max_iter == 5000
    assert len(models.forest_grid().settings) == 12


def test_registered_runs_use_the_default_stop_words():
    assert mq.TEXT.stop_words is None


@pytest.mark.parametrize("name", ["lr_top_terms", "score_text", "gbt_direction", "gbt_return"])
def test_registered_models_are_trained(spark, name):
    rows = getattr(mq, name)(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == {"lr_top_terms": 60, "gbt_direction": 5, "gbt_return": 1}.get(name, len(rows)) > 0
