"""Scratch tables under the shared folder."""

from pathlib import Path

from revlens import session


def test_clear_scratch_removes_only_the_applications_tables(spark, monkeypatch):
    # an application of its own, so that other tests keep their tables
    base = session.scratch_root(spark)
    monkeypatch.setattr(session, "scratch_root", lambda s: f"{base}-cleared")
    assert session.write_table(spark.range(3).toDF("x"), "kept").count() == 3
    root = Path(f"{base}-cleared".removeprefix("file:"))
    other = root.parent / "another-application"
    other.mkdir(parents=True, exist_ok=True)
    assert session.clear_scratch(spark) and not root.exists() and other.exists()
    assert not session.clear_scratch(spark)
    assert session.write_table(spark.range(2).toDF("x"), "again").count() == 2
