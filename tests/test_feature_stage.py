"""The full feature catalogue writes the feature stage only, not the labelled one beside it."""

import catalogue.base as base
from catalogue import QUERIES
from tests.conftest import DATA


def test_full_feature_catalog_writes_no_labelled_stage(spark, monkeypatch):
    monkeypatch.setattr(base, "_STAGES", {})
    df = QUERIES["ml06_full_feature_catalog"](spark, DATA)
    assert df.count() > 0
    labels = {key[2] for key in base._STAGES}
    assert "features" in labels
    assert "labelled" not in labels
