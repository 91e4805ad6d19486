"""Queries that apply batches of the board read them, computed once, from files."""

from __future__ import annotations

from boardwalk.plans import registered

SF = "/root/testdata/sf0.001"


def test_batches_read_what_was_computed_once(spark, monkeypatch):
    seen = []
    for name in ("append_latest", "append_rollup"):
        was = getattr(registered, name)
        monkeypatch.setattr(registered, name, lambda batch, *a, was=was: (seen.append(batch.inputFiles()), was(batch, *a)))
    registered.stream_upsert_replayed(spark, SF)
    registered.rollup_first_snapshot(spark, SF)
    assert len(seen) == 9
    assert all(files and all("-batches-" in f for f in files) for files in seen)
