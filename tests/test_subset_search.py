"""The subset run searches for the names of its own rows only."""

import __spark_entry__ as entry
from weft.operators import nearest


def test_subset_searches_for_its_own_names_only(spark, sf, monkeypatch):
    asked = []
    monkeypatch.setattr(nearest, "top_names", lambda a, *x, real=nearest.top_names, **k: asked.append(a.count()) or real(a, *x, **k))
    rows = entry.queries()["c14_subset_run"](spark, sf).count()
    assert asked and asked[0] <= rows
