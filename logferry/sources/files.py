"""Small file operations on whatever Hadoop file system a path names."""

from __future__ import annotations

import json
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class AlreadyPublished(RuntimeError):
    """Another writer published the same target first."""


class Files:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def mkdirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def delete_empty(self, path: str) -> None:
        """Delete a folder if it holds nothing."""
        if self.exists(path) and not self.names(path):
            self.delete(path)

    def size(self, path: str) -> int:
        """Bytes of all files under ``path``."""
        return self._fs(path).getContentSummary(self._path(path)).getLength()

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs(path).listStatus(self._path(path))]

    def numbers(self, path: str, key: str) -> list[int]:
        """Sorted numbers of the ``key=<n>`` directories under ``path``."""
        found = (n.split("=", 1)[1] for n in self.names(path) if n.startswith(f"{key}="))
        return sorted(int(n) for n in found if n.isdigit())

    def older(self, path: str, key: str, seconds: float) -> list[int]:
        """Numbers of the ``key=<n>`` directories that are older than ``seconds``."""
        before = (time.time() - seconds) * 1000
        found = [s for s in self._fs(path).listStatus(self._path(path)) if s.getModificationTime() < before]
        names = (s.getPath().getName() for s in found)
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{key}="))

    def last(self, path: str, key: str) -> int:
        """Largest ``n`` for which ``key=<n>`` exists under ``path``, when all from 1 on do.

        Takes a few look-ups instead of a listing, which would grow with ``n``.
        """
        beyond = 1
        while self.exists(f"{path}/{key}={beyond}"):
            beyond *= 2
        found = beyond // 2
        while beyond - found > 1:
            middle = (found + beyond) // 2
            if self.exists(f"{path}/{key}={middle}"):
                found = middle
            else:
                beyond = middle
        return found

    def read_json(self, path: str) -> dict:
        stream = self._fs(path).open(self._path(path))
        try:
            text = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def write_json(self, path: str, content: dict) -> None:
        stream = self._fs(path).create(self._path(path), True)
        try:
            stream.write(bytearray(json.dumps(content, indent=1, sort_keys=True).encode()))
        finally:
            stream.close()

    def publish(self, staged: str, target: str) -> None:
        """Rename ``staged`` to ``target`` unless the target exists: claim and publish in one step."""
        options = self._spark._sc._gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = self._hadoop.Options.Rename.NONE
        context = self._hadoop.FileContext.getFileContext(self._path(staged).toUri(), self._conf)
        try:
            context.rename(self._path(staged), self._path(target), options)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise AlreadyPublished(f"{target} already exists") from error
            raise


def fresh_name() -> str:
    return uuid.uuid4().hex


def shared_folder(spark: SparkSession) -> str:
    """A new folder inside the one that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    path = f"{shared}/run-{fresh_name()}"
    Files(spark).mkdirs(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and not again when a task is lost."""
    path = f"{shared_folder(df.sparkSession)}/rows"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
