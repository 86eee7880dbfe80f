from datetime import timedelta

from fleetmart.llm import base


def test_expired_work(spark, tmp_path, monkeypatch):
    """Only old folders below this package's own go; a folder that never was is no error."""
    monkeypatch.setattr(base, "_work_root", lambda spark: f"{tmp_path}/mine")
    assert base.expire_work(spark, timedelta(0)) == 0
    kept = base.staged(spark.range(3), "kept")
    (tmp_path / "other").mkdir()
    assert base.expire_work(spark, timedelta(hours=1)) == 0 and kept.count() == 3
    assert base.expire_work(spark, timedelta(seconds=-60)) == 1
    assert list((tmp_path / "mine").iterdir()) == [] and (tmp_path / "other").exists()


def test_work_lies_below_the_shared_folder(spark):
    folder = base.shared_folder(spark, "x")
    assert folder.startswith(f"{base._work_root(spark)}/x-") and folder != base.shared_folder(spark, "x")
