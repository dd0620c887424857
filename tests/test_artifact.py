"""Artifacts on disk: a good one, and each rule broken."""

import json
import os

import pytest

from corvane.sources import artifact as K
from corvane.sources.archive import ArchiveError


@pytest.fixture
def root(tmp_path):
    for path, text in {"data/state.json": '{"status": "ok", "last_run_at": "2026-01-02T00:00:00Z"}', "data/raw/2026/01/02/items.ndjson": "{}\n", "data/errors/2026/01/02/errors.ndjson": "", "reports/daily/2026-01-02.md": "# x\n", "reports/weekly/w.md": "w", "config/x.json": "{}"}.items():
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    return tmp_path


def broken(spark, root):
    return sorted((r.key, r.rule) for r in K.verify(spark, str(root), "manifest.json").collect())


def test_round_trip(spark, root):
    made = K.write_manifest(spark, str(root), "manifest.json")
    assert [f["path"] for f in made["files"]] == ["data/errors/2026/01/02/errors.ndjson", "data/raw/2026/01/02/items.ndjson", "data/state.json", "reports/daily/2026-01-02.md"] and (made["file_count"], made["total_bytes"]) == (4, 62)
    assert broken(spark, root) == []
    for output in ("data/m.json", "../m.json", "."):
        with pytest.raises(ArchiveError, match="must lie"):
            K.write_manifest(spark, str(root), output)
    assert [r.rule for r in K.verify(spark, str(root), "none.json").collect()] == ["not_a_file"]
    os.symlink(root / "manifest.json", root / "link.json")
    assert [r.rule for r in K.verify(spark, str(root), "link.json").collect()] == ["not_a_file"]


def test_files_that_changed(spark, root):
    K.write_manifest(spark, str(root), "manifest.json")
    (root / "data/raw/2026/01/02/items.ndjson").write_text("[]\n")
    (root / "reports/daily/2026-01-02.md").write_text("longer\n")
    (root / "data/errors/2026/01/02/errors.ndjson").unlink()
    (root / "data/raw/2026/01/03").mkdir()
    (root / "data/raw/2026/01/03/items.ndjson").write_text("")
    (root / "data/raw/2026/01/02/run.sh").write_text("")
    os.symlink("/etc/passwd", root / "data/raw/2026/01/02/errors.ndjson")
    os.mkfifo(root / "reports/pipe")
    (root / "data/state.json").write_text('{"status": "partial", "last_run_at": null}')
    assert broken(spark, root) == sorted([
        ("data/raw/2026/01/02/items.ndjson", "digest"), ("reports/daily/2026-01-02.md", "size"), ("data/errors/2026/01/02/errors.ndjson", "missing"), ("data/raw/2026/01/03/items.ndjson", "unexpected"), ("data/raw/2026/01/02/run.sh", "unexpected_path"), ("data/raw/2026/01/02/errors.ndjson", "link"), ("reports/pipe", "special"),
        ("data/state.json", "size"), ("manifest", "total_bytes"), ("manifest", "state_differs"), ("manifest", "last_run_differs")])
    with pytest.raises(ArchiveError, match="not an artifact"):
        K.write_manifest(spark, str(root), "other.json")


def test_manifests_that_are_none(spark, root):
    good = K.write_manifest(spark, str(root), "manifest.json")
    file = good["files"][0]

    def rules(value):
        (root / "manifest.json").write_text(value if isinstance(value, str) else json.dumps(value))
        return {r for _, r in broken(spark, root)}

    assert rules(good | {"more": 1}) == {"fields"} and rules(good | {"schema": "x"}) == {"schema"} and rules(good | {"file_count": "4"}) == {"file_count"} and rules(good | {"total_bytes": 1}) == {"total_bytes"} and rules(good | {"last_run_at": 5}) == {"last_run_at", "last_run_differs"} and rules(good | {"state_status": "odd"}) == {"state_status", "state_differs"}
    assert rules(good | {"files": [*good["files"], file]}) == {"repeated"} and rules(good | {"files": [file | {"sha256": "A" * 64}, *good["files"][1:]]}) == {"sha256", "digest"} and rules(good | {"files": [file | {"bytes": -1}, *good["files"][1:]]}) == {"bytes", "size"} and rules(good | {"files": [file | {"x": 1}, *good["files"][1:]]}) == {"file_fields"}
    assert rules(good | {"files": [*good["files"], file | {"path": "../x"}, 5]}) == {"path", "file_fields", "bytes", "sha256"} and rules(good | {"files": {}}) == {"files", "unexpected"} and {"manifest", "fields", "unexpected"} <= rules("[") and {"manifest", "fields"} <= rules("[]")


def test_roots_that_are_links(spark, root, tmp_path):
    K.write_manifest(spark, str(root), "manifest.json")
    os.rename(root / "reports", root / "elsewhere")
    os.symlink(root / "elsewhere", root / "reports")
    assert ("reports", "link") in broken(spark, root) and ("reports/daily/2026-01-02.md", "missing") in broken(spark, root)
