"""Files of keys, written by tasks and by the table writer, and how they are dealt to tasks."""

import json
import os

from clipsift.session import scratch_path
from clipsift.sources import manifest, readers, writers
from clipsift.sources.files import Folder
from clipsift.sources.manifest import DocumentTable


def tree(root):
    found = {}
    for folder in os.listdir(root):
        if "=" in folder:
            (name,) = [n for n in os.listdir(f"{root}/{folder}") if not n.startswith((".", "_"))]
            found[folder] = sorted(open(f"{root}/{folder}/{name}").read().split("\n"))
    return found


def test_tasks_write_what_the_table_writer_does(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("v1", "a\n b"), ("v2", ""), ("v-3", None), ("v4", "x"), ("v4", "y"), (None, "n"), (None, "m")], "id string, value string"
    )
    more = spark.createDataFrame([("v1", "new"), ("v9", "é")], "id string, value string")
    both = []
    for table_writer in (False, True):
        root = scratch_path(spark, "folders")
        with monkeypatch.context() as m:
            if table_writer:
                m.setattr(Folder, "on_disk", lambda self: None)
            writers.write_keyed_files(rows, root)
            writers.write_keyed_files(more, root)
        both.append(tree(root))
    assert both[0] == both[1] and len(both[0]) == 6 and both[0]["id=v1"] == ["", "new"]


def test_no_rows_leave_an_empty_folder(spark):
    root = scratch_path(spark, "folders")
    writers.write_keyed_files(spark.createDataFrame([], "id string, value string"), root)
    assert os.listdir(root) == [] and readers.read_keyed_metadata(spark, root, "n long", files="*.txt").count() == 0


def test_small_files_share_tasks(spark, tmp_path, monkeypatch):
    for i in range(400):
        (tmp_path / f"v{i}").mkdir()
        (tmp_path / f"v{i}" / "metadata.json").write_text(json.dumps({"n": i}))
    tasks = []
    real = readers.durable
    monkeypatch.setattr(readers, "durable", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or real(df, name))
    found = readers.read_keyed_metadata(spark, str(tmp_path), "n long")
    assert sorted(r["n"] for r in found.collect()) == list(range(400))
    assert tasks[0] <= 4  # 13 at the default cost of opening a file


def test_refresh_opens_small_files_in_few_tasks(spark, tmp_path, monkeypatch):
    for i in range(400):
        (tmp_path / "in" / f"v{i}").mkdir(parents=True)
        (tmp_path / "in" / f"v{i}" / "metadata.json").write_text(json.dumps({"n": i}))
    tasks = []
    real = manifest.durable
    monkeypatch.setattr(manifest, "durable", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or real(df, name))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    table = DocumentTable(spark, str(tmp_path / "t"), "n long", buckets=2)
    assert table.refresh(str(tmp_path / "in")) == {"opened": 400, "gone": 0}
    assert tasks[0] <= 4 and table.read().count() == 400
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
