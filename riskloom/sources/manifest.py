"""Hand-over between stages: a stage's tables count once its manifest is published.

A stage withdraws its manifest, writes its tables, and publishes a new manifest
last (written under another name, then renamed): the fingerprint of what it
read and its tables' row counts.  A reader asks for the manifest before a
table, so it never reads half an overwrite, and a run whose fingerprint is
published already need not be repeated.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import SparkSession

from riskloom.sources.io import path_exists


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, paths: list[str], settings: dict) -> str:
    """Of the files below the paths (name, length, time of change) and the settings."""
    h = hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode())
    for path in paths:
        h.update(path.encode())
        if path_exists(spark, path):
            fs, p = _fs(spark, path)
            files, found = fs.listFiles(p, True), []
            while files.hasNext():
                f = files.next()
                found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
            h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()


class Manifests:
    """The manifests of one output folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.folder = spark, os.path.join(out, "_manifests")

    def path(self, stage: str) -> str:
        return os.path.join(self.folder, f"{stage}.json")

    def read(self, stage: str) -> dict | None:
        if not path_exists(self.spark, self.path(stage)):
            return None
        fs, p = _fs(self.spark, self.path(stage))
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def finished(self, stage: str, mark: str) -> bool:
        m = self.read(stage)
        return m is not None and m["fingerprint"] == mark

    def withdraw(self, stage: str) -> None:
        fs, p = _fs(self.spark, self.path(stage))
        fs.delete(p, False)

    def publish(self, stage: str, mark: str, counts: dict[str, int]) -> None:
        draft = self.path(stage) + ".draft"
        fs, p = _fs(self.spark, draft)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps({"stage": stage, "fingerprint": mark, "rows": counts}, sort_keys=True).encode()))
        finally:
            stream.close()
        if not fs.rename(p, _fs(self.spark, self.path(stage))[1]):
            raise OSError(f"cannot publish {self.path(stage)}")

    def require(self, stage: str) -> dict:
        m = self.read(stage)
        if m is None:
            raise FileNotFoundError(f"stage {stage} has no finished output in {os.path.dirname(self.folder)}")
        return m
