"""Files that tasks find and open, against Spark's own reader, which holds their names on the driver."""

import json
import os

import pytest

from clipsift.sources import listings, manifest
from clipsift.sources.files import Folder
from clipsift.sources.manifest import DocumentTable

NAMES = ("m.txt", "m.json", "a.TXT", "_q.txt", "_q=1.txt", "_metadata.txt", ".dot.txt", "c.txt._COPYING_", "é [1]{2}.txt")


def odd_tree(root):
    for i, folder in enumerate((".", "id=a b", "id=a%2Fb", "_hid", "_h=x", ".dot", "_metadata", "copy._COPYING_", "x{1},y+é", "d/e/f/g", "none")):
        (root / folder).mkdir(parents=True, exist_ok=True)
        for name in () if folder == "none" else NAMES:
            (root / folder / name).write_text(f"{folder} {name}\n")
            os.utime(root / folder / name, ns=(0, 1_600_000_000_123_456_789 + i * 10**9))
    (root / "d" / "empty.txt").write_text("")
    (root / "d" / "bytes.txt").write_bytes(b"\xff\x00\r\n")


def make(root):
    for i in range(300):
        (root / "in" / f"v{i}").mkdir(parents=True)
        (root / "in" / f"v{i}" / "metadata.json").write_text(json.dumps({"n": i}))


@pytest.mark.parametrize("files", ["*", "*.txt", "[mé]*.{txt,json}", "m.???", "none"])
def test_tasks_find_and_open_what_the_reader_does(spark, tmp_path, monkeypatch, files):
    odd_tree(tmp_path)
    both = []
    for reader in (False, True):
        with monkeypatch.context() as m:
            if reader:
                m.setattr(Folder, "on_disk", lambda self: None)
            for root in (str(tmp_path), f"file://{tmp_path}/"):
                opened = [tuple(r) for r in listings.binary_files(spark, root, files).collect()]
                listed = [tuple(r) for r in listings.list_files(spark, root, files).collect()]
                assert sorted(listed) == sorted((path, size, stamp) for path, stamp, size, _ in opened)
                both.append(sorted(opened))
    assert both[0] == both[1] == both[2] == both[3] and (files == "none") == (both[0] == [])


def test_named_files_are_opened_by_tasks(spark, tmp_path):
    odd_tree(tmp_path)
    (tmp_path / "d" / "a*b?.txt").write_text("marks")
    paths = [r[0] for r in listings.list_files(spark, str(tmp_path), "*.txt").collect()]
    found = listings.binary_files(spark, [manifest._literal(p) for p in paths], "*.txt")
    assert sorted(r["path"] for r in found.collect()) == sorted(paths) and found.inputFiles() == []
    with pytest.raises(Exception, match="FileNotFoundError"):
        listings.binary_files(spark, [f"file:{tmp_path}/gone.txt"], "*.txt").collect()


def test_the_driver_holds_no_names(spark, tmp_path):
    """Before, the plan of a scan listed every file."""
    make(tmp_path)
    for frame in (listings.binary_files(spark, str(tmp_path / "in")), listings.list_files(spark, str(tmp_path / "in"))):
        assert not any("metadata.json" in name for name in frame.inputFiles()) and frame.count() == 300
    table = DocumentTable(spark, str(tmp_path / "t"), "n long", buckets=2)
    assert table.refresh(str(tmp_path / "in")) == {"opened": 300, "gone": 0}
    assert table.refresh(str(tmp_path / "in")) == {"opened": 0, "gone": 0}


def test_patterns_and_missing_folders_go_to_the_reader(spark, tmp_path):
    odd_tree(tmp_path)
    some = listings.list_files(spark, f"{tmp_path}/id=*", "m.txt")
    assert sorted(os.path.basename(os.path.dirname(r["path"])) for r in some.collect()) == ["id=a b", "id=a%2Fb"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        listings.list_files(spark, str(tmp_path / "nowhere"))
    one = listings.binary_files(spark, str(tmp_path / "m.txt")).collect()
    assert [bytes(r["content"]) for r in one] == [b". m.txt\n"]
