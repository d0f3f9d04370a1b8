from datetime import datetime, timezone

import pytest

from topicloom.functions import config
from topicloom.operators import optional


def test_trees():
    assert config.difference({"a": {"b": 1, "c": [1]}}, {"a": {"b": 2, "c": [1]}, "d": 3}) == {"a.b": (1, 2), "d": (None, 3)}
    assert config.snapshot({"b": 1, "a": 2}) == '{"a": 2, "b": 1}'


def test_checks():
    config.check_weights({"a": 0.5, "b": 0.5})
    for bad in ({"a": 0.5}, {"a": 1.5, "b": -0.5}):
        with pytest.raises(ValueError):
            config.check_weights(bad)
    with pytest.raises(ValueError):
        config.check_open_unit(threshold=1.0)
    assert config.by_backend(0.5, "x") == 0.5 and config.by_backend({"x": None}, "x") is None
    with pytest.raises(ValueError):
        config.by_backend({"y": 0.5}, "x")


def test_names():
    assert config.run_id(datetime(2026, 1, 2, 3, 4, tzinfo=timezone.utc)) == "2026-01-02T0304"
    assert config.with_parameter("http://h/p?a=1&page=2&a=3", "page", 5) == "http://h/p?a=1&a=3&page=5"


def test_optional_packages_are_named():
    with pytest.raises(ImportError, match="sentence_transformers"):
        optional.transformer_vectors(None, "id", "text", "m")
    with pytest.raises(ImportError, match="umap"):
        optional.density_topics(None, "id", "v", 5)
