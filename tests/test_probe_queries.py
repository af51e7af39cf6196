"""The registered probe queries run the default search."""

import inspect

import pytest

from lamella.operators import probe
from lamella.plans import QUERIES, scoring


@pytest.mark.parametrize("name", ["linear_probe", "bag_probe"])
def test_query_uses_the_whole_search(spark, monkeypatch, name):
    seen, whole = {}, probe.linear_probe
    own = inspect.signature(whole)

    def spy(*args, **options):
        bound = own.bind(*args, **options)
        bound.apply_defaults()
        seen.update(bound.arguments)
        raise InterruptedError
    monkeypatch.setattr(probe, "linear_probe", spy)
    with pytest.raises(InterruptedError):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    seeds = 5 if name == "linear_probe" else 3
    assert (seen["c_values"], seen["folds"], seen["seeds"], seen["replicates"], seen["max_iter"]) == (probe.C_VALUES, 5, seeds, 1000, 100)
    assert scoring.probe is probe
