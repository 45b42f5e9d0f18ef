"""Which runs of a warehouse are published: one small file per version, created or refused as a whole.

    <warehouse>/published/v0000000001.json

Two loads that started from the same version want the same file; whoever creates it has published,
the other one is told. Versions are never changed or removed, so any published run can be opened again.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class PublishConflict(RuntimeError):
    """Another load published first. The run itself is complete and can be opened by its id."""


def _folder(spark: SparkSession, warehouse: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse}/published")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _file(spark: SparkSession, folder, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder, name)


def _already_there(error: Py4JJavaError) -> bool:
    return "AlreadyExists" in error.java_exception.getClass().getSimpleName()


def _write(fs, path, text: str) -> None:
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _create(spark: SparkSession, fs, folder, name: str, text: str) -> bool:
    """Create a file with its content unless there is one of that name.

    File systems of a cluster create or refuse at once (object stores, where conditional writes are on).
    The local one looks first and creates then, so there a finished draft is linked to the name instead.
    """
    try:
        if fs.getScheme() != "file":
            _write(fs, _file(spark, folder, name), text)
            return True
        draft = _file(spark, folder, f"_draft-{uuid.uuid4().hex}")
        _write(fs, draft, text)
        try:
            local = [spark._jvm.java.io.File(_file(spark, folder, n).toUri().getPath()).toPath() for n in (name, draft.getName())]
            spark._jvm.java.nio.file.Files.createLink(*local)
        finally:
            fs.delete(draft, False)
        return True
    except Py4JJavaError as error:
        if _already_there(error):
            return False
        raise


def versions(spark: SparkSession, warehouse: str) -> list[int]:
    """Numbers of the versions, ascending."""
    fs, folder = _folder(spark, warehouse)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _name(version: int) -> str:
    return f"v{version:010d}.json"


def entry(spark: SparkSession, warehouse: str, version: int) -> dict[str, Any] | None:
    """What a version says; None for a file whose writer was lost before its content was there."""
    fs, folder = _folder(spark, warehouse)
    stream = fs.open(_file(spark, folder, _name(version)))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text else None


def latest(spark: SparkSession, warehouse: str) -> dict[str, Any] | None:
    """The newest version that is complete."""
    for version in reversed(versions(spark, warehouse)):
        if found := entry(spark, warehouse, version):
            return found
    return None


def publish(spark: SparkSession, warehouse: str, run_id: str, after: int, details: dict[str, Any]) -> int:
    """Publish a run as the version behind ``after``, the one that its load saw as the newest (0: none)."""
    fs, folder = _folder(spark, warehouse)
    fs.mkdirs(folder)
    version = after + 1
    text = json.dumps({"version": version, "run_id": run_id, **details})
    if any(v > after for v in versions(spark, warehouse)) or not _create(spark, fs, folder, _name(version), text):
        raise PublishConflict(f"run {run_id}: version {version} is another load's")
    return version
