import glob

from cartwheel.llm import common


def test_stored_tables_of_a_run_are_dropped_together(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda spark: f"file://{tmp_path}")
    (tmp_path / "other").mkdir()
    a, b = common.stored(spark.range(10), "a"), common.stored(spark.range(0), "b")
    assert a.count() == 10 and b.count() == 0
    assert len(glob.glob(f"{tmp_path}/cartwheel-llm-*/*")) == 2
    common.drop_stored(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
    common.drop_stored(spark)  # nothing left: nothing happens
