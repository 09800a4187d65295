"""Versions of a state in parquet, and the pointer that makes one of them current.

Readers see the version that the pointer names. A new one is written beside it; moving the pointer is the commit, not
moving it the rollback. A pointer is one small file that is written under another name and renamed, through Hadoop's file
system, so folders may lie anywhere that Spark reaches.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class VersionedStore:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        if not self._fs.exists(self._at(f"{self.path}/commits")):
            return []
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(self._at(f"{self.path}/commits")) if f.getPath().getName().isdigit())

    def current(self) -> dict[str, Any] | None:
        """The latest commit: version, folder, and what was said of it."""
        found = self._versions()
        if not found:
            return None
        stream = self._fs.open(self._at(f"{self.path}/commits/{found[-1]}"))
        try:
            return json.loads(bytes(b & 0xFF for b in stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self) -> DataFrame:
        commit = self.current()
        return self.spark.createDataFrame([], self.schema) if commit is None else self.spark.read.schema(self.schema).parquet(commit["folder"])

    def stage(self, df: DataFrame) -> str:
        """Writes a version that nobody reads yet; returns its folder."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def commit(self, folder: str, **said: Any) -> int:
        """Makes a staged folder current. Of two that commit at once, the one whose rename comes second fails."""
        version = (self._versions() or [0])[-1] + 1
        text = json.dumps({"version": version, "folder": folder} | said)
        draft = self._at(f"{self.path}/drafts/{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._fs.mkdirs(self._at(f"{self.path}/commits"))
        target = self._at(f"{self.path}/commits/{version}")
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            raise RuntimeError(f"version {version} was committed by another writer")
        return version

    def vacuum(self, keep: int = 2) -> None:
        """Deletes data folders that none of the last ``keep`` commits names."""
        names = set()
        for v in self._versions()[-keep:]:
            stream = self._fs.open(self._at(f"{self.path}/commits/{v}"))
            names.add(json.loads(bytes(b & 0xFF for b in stream.readAllBytes()).decode())["folder"].rsplit("/", 1)[-1])
            stream.close()
        data = self._at(f"{self.path}/data")
        for f in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if f.getPath().getName() not in names:
                self._fs.delete(f.getPath(), True)
