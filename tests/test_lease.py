"""One active run a table root."""

import pytest

from tidemark.operators import quality as QU
from tidemark.plans import pipeline as PL
from tidemark.sources import fixtures as FX
from tidemark.sources import lease as LE

SF = "/root/testdata/sf0.001"


def test_one_holder_and_takeover(spark, tmp_dir):
    assert LE.current(spark, tmp_dir) == (0, None)
    n = LE.acquire(spark, tmp_dir, "a", 100, now=1000.0)
    with pytest.raises(LE.LeaseHeld, match="run a holds"):
        LE.acquire(spark, tmp_dir, "b", 100, now=1099.0)
    # the holder died: its lease ends, the next one takes over, and a late release changes nothing
    m = LE.acquire(spark, tmp_dir, "b", 100, now=1100.0)
    assert m == n + 1
    LE.release(spark, tmp_dir, n)
    assert LE.current(spark, tmp_dir) == (m, {"holder": "b", "ends": 1200.0})
    LE.release(spark, tmp_dir, m)
    assert LE.acquire(spark, tmp_dir, "c", 100, now=1101.0) == m + 2


def test_a_taken_number_is_refused(spark, tmp_dir):
    folder = LE._folder(tmp_dir)
    assert LE._create(spark, folder, 1, {"holder": "a", "ends": 9.0})
    assert not LE._create(spark, folder, 1, {"holder": "b", "ends": 9.0})
    assert LE.current(spark, tmp_dir) == (1, {"holder": "a", "ends": 9.0})


def test_a_second_run_refuses_and_changes_nothing(spark, tmp_dir):
    batch = FX.bronze_clean(spark, SF).limit(50)
    with LE.held(spark, tmp_dir, "other", 3600):
        with pytest.raises(LE.LeaseHeld):
            PL.run_pipeline(spark, batch, tmp_dir, "r1", FX.AS_OF)
        assert PL.run_history(spark, tmp_dir) is None
    # free again; a run that fails its gate gives the lease back too
    with pytest.raises(QU.QualityGateError):
        PL.run_pipeline(spark, FX.bronze(spark, SF), tmp_dir, "r2", FX.AS_OF)
    assert PL.run_pipeline(spark, batch, tmp_dir, "r3", FX.AS_OF).status == "succeeded"
