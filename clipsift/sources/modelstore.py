"""Versioned store of fitted models, scalers and network weights.

``root/versions/<version>`` holds one model with a manifest, written last: a version without one
was not finished and is never seen. ``root/current/<number>`` are pointers, each naming a version;
the highest number counts. A pointer is created only if no other has its number, so two jobs that
publish at once both succeed, one after the other, and a reader sees one whole version or the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession

from clipsift.operators.scaling import Scaler
from clipsift.session import scratch_path
from clipsift.sources.files import Folder

ATTEMPTS = 32


def plain_model(model, spark: SparkSession):
    """The fitted model as it is read back from the shared folder.

    What fitting leaves on it is gone: a training summary holds the session and the training plan,
    travels with the model into every task, and cannot be serialised once the session observes a frame.
    """
    path = scratch_path(spark, "model")
    model.write().save(path)
    return DefaultParamsReader.loadParamsInstance(path, spark)


class ModelStore:
    """Models below ``root``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = Folder(spark, root)

    def versions(self) -> list[str]:
        """Finished versions, in the order of their names."""
        return [v for v in self.folder.names("versions") if self.folder.exists(f"versions/{v}/manifest.json")]

    def info(self, version: str) -> dict:
        return json.loads(self.folder.read(f"versions/{version}/manifest.json"))

    def current(self) -> str | None:
        """The version that the newest pointer names; one still being written does not count."""
        finished = set(self.versions())
        for number in reversed([n for n in self.folder.names("current") if not n.startswith((".", "_"))]):
            version = self.folder.read(f"current/{number}").strip()
            if version in finished:
                return version
        return None

    def promote(self, version: str) -> None:
        """Make a finished version the current one; an older one may come back."""
        if version not in self.versions():
            raise KeyError(f"no finished version {version!r}")
        for _ in range(ATTEMPTS):
            number = int(([n for n in self.folder.names("current") if n.isdigit()] or ["0"])[-1]) + 1
            name = f"current/{number:012d}"
            try:
                self.folder.create(name, version)
                return
            except Py4JJavaError:  # another job took the number meanwhile
                if not self.folder.exists(name):
                    raise
        raise OSError("too many jobs publish at once")

    def publish(self, model, info: dict | None = None, version: str | None = None, promote: bool = True) -> str:
        """Save a model as a new version and, unless told otherwise, make it the current one."""
        version = version or f"{len(self.folder.names('versions')):06d}-{uuid.uuid4().hex[:8]}"
        if version in self.versions():
            raise ValueError(f"version {version!r} is finished already")
        path = f"{self.root}/versions/{version}"
        self.folder.delete(f"versions/{version}")  # the rest of a run that failed
        manifest = {"version": version, "info": info or {}, **_save(self.spark, model, f"{path}/model")}
        self.folder.create(f"versions/{version}/manifest.json", json.dumps(manifest))
        if promote:
            self.promote(version)
        return version

    def load(self, version: str | None = None):
        """The model of a version, or the current one."""
        version = version or self.current()
        if version is None:
            raise LookupError(f"nothing is published in {self.root}")
        return _load(self.spark, self.info(version), f"{self.root}/versions/{version}/model")


def _save(spark: SparkSession, model, path: str) -> dict:
    if isinstance(model, Scaler):
        model.params.write.parquet(path)
        return {"kind": "scaler", "cols": list(model.cols)}
    if isinstance(model, dict):
        rows = [(i, list(a.shape), a.ravel().astype(float).tolist()) for i, a in enumerate(_arrays(model))]
        spark.createDataFrame(rows, "position int, shape array<int>, values array<double>").write.parquet(path)
        return {"kind": "weights", "layout": _layout(model, iter(range(len(rows))))}
    model.write().save(path)
    return {"kind": "ml"}


def _load(spark: SparkSession, manifest: dict, path: str):
    if manifest["kind"] == "scaler":
        return Scaler(spark.read.parquet(path), tuple(manifest["cols"]))
    if manifest["kind"] == "weights":
        rows = spark.read.parquet(path).orderBy("position").collect()  # as many as the network has layers
        return _filled(manifest["layout"], [np.array(r["values"]).reshape(r["shape"]) for r in rows])
    return DefaultParamsReader.loadParamsInstance(path, spark)


def _arrays(part) -> Iterator[np.ndarray]:
    if isinstance(part, np.ndarray):
        yield part
    else:
        for inner in part.values() if isinstance(part, dict) else part:
            yield from _arrays(inner)


def _layout(part, numbers: Iterator[int]):
    """Nesting of the weights, each array as its number."""
    if isinstance(part, np.ndarray):
        return next(numbers)
    if isinstance(part, dict):
        return {"dict": [[name, _layout(inner, numbers)] for name, inner in part.items()]}
    return {"tuple" if isinstance(part, tuple) else "list": [_layout(inner, numbers) for inner in part]}


def _filled(layout, arrays: list[np.ndarray]):
    if isinstance(layout, int):
        return arrays[layout]
    ((kind, inner),) = layout.items()
    if kind == "dict":
        return {name: _filled(x, arrays) for name, x in inner}
    return (tuple if kind == "tuple" else list)(_filled(x, arrays) for x in inner)
