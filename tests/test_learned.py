"""The model queries take all rounds."""

from dataclasses import replace

import pytest

from bondscope.operators import boosting, models
from bondscope.queries import boosted, learned
from check import database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def asked(monkeypatch):
    """The settings that a query fits its model with; the fit itself takes two rounds."""
    found, fit = [], models.fit

    def short(train, features, targets, settings, **rest):
        found.append(settings)
        return fit(train, features, targets, replace(settings, iterations=2), **rest)

    monkeypatch.setattr(models, "fit", short)
    return found


@pytest.mark.parametrize("name", ["batch_scoring", "model_parameters", "regression", "saved_model"])
def test_all_rounds(spark, asked, name):
    assert learned.QUERIES[name](spark, FOLDER).count() > 0
    assert [(s.iterations, s.learning_rate, s.depth) for s in asked] == [(1000, 0.1, 6)]


def test_parameters_are_those_of_the_trees(spark):
    """The count of the trees that were grown, not of those that were asked for."""
    found = learned.model_parameters(spark, FOLDER).first()
    assert (found["iterations"], found["learning_rate"]) == (1000, 0.1)


def test_all_rounds_of_classes(spark, monkeypatch):
    found, fit = [], boosting.fit

    def short(rows, features, targets, settings, key):
        found.append(settings)
        return fit(rows, features, targets, replace(settings, iterations=2), key)

    monkeypatch.setattr(boosting, "fit", short)
    assert boosted.softmax_classes(spark, FOLDER).count() == 1000
    assert [(s.iterations, s.learning_rate, s.depth, s.bins) for s in found] == [(1000, 0.1, 6, 254)]


@pytest.mark.parametrize("bins", [32, 254])
def test_looped_check_equals_the_written_out_one(bins):
    """The recursion finds what two rounds written out one after the other find."""
    settings, connection = replace(boosted.SETTINGS, bins=bins), database(FOLDER)
    select = "SELECT event_id, " + ", ".join(f"round(s{t}_{k}, 9)" for t, k in boosted.EVENTS.outputs) + " FROM final ORDER BY 1"
    looped, written = (connection.execute(made(boosted.EVENTS, settings, select)).fetchall()
                       for made in (boosted.looped_sql, boosted.trees_sql))
    assert len(looped) == 1000 and looped == written
