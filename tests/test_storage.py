"""Written tables that stay and tables that go, whatever the form of the shared folder's name."""

from __future__ import annotations

from pathlib import Path

import pytest

from framewright import storage


@pytest.mark.parametrize("form", ["{}/plain", "{}/with a space", "file:{}/short", "file://{}/long", "file://{}/per%20cent"])
def test_kept_tables_stay(spark, tmp_path, monkeypatch, form):
    monkeypatch.setattr(storage, "shared_dir", lambda _: form.format(tmp_path))
    with storage.intermediates(spark) as made:
        gone = storage.materialize(spark.range(3).toDF("x"), "gone")
        kept = storage.materialize(spark.range(4).toDF("x"), "kept")
        none = storage.materialize(spark.range(0).toDF("x"), "none")
        made.keep(kept)
        made.keep(none)
        assert gone.count() == 3
    assert kept.count() == 4 and none.count() == 0
    left = [p.name.partition("-")[0] for p in Path(tmp_path).glob("*/framewright/*")]
    assert sorted(left) == ["kept", "none"]
