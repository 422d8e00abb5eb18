import os

import pytest

from cohortlens.session import materialize, scratch_root, scratch_run


def test_a_run_leaves_no_scratch(spark):
    with scratch_run(spark):
        root = scratch_root(spark)
        assert materialize(spark.range(3), "numbers").count() == 3
        assert os.listdir(root)
    assert not os.path.exists(root) and scratch_root(spark) != root


def test_scratch_goes_after_a_failure(spark):
    with pytest.raises(ZeroDivisionError):
        with scratch_run(spark):
            root = scratch_root(spark)
            materialize(spark.range(3), "numbers")
            1 / 0
    assert not os.path.exists(root)
