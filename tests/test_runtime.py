"""Shared helpers: bounds, lineage cuts, cleaning."""

from pathlib import Path

import pytest

from sedgeline import runtime


def test_bounded_rows(spark):
    assert len(runtime.bounded_rows(spark.range(3), 3, "numbers")) == 3
    with pytest.raises(ValueError):
        runtime.bounded_rows(spark.range(4), 3, "numbers")


def test_stored_and_cleared(spark):
    assert runtime.cut(spark.range(5)).count() == 5 and runtime.stored(spark.range(7)).count() == 7
    folder = Path(runtime.shared_dir(spark).removeprefix("file:")) / "sedgeline" / spark.sparkContext.applicationId
    assert folder.exists()
    runtime.clear_stored(spark)
    assert not folder.exists()
