"""Small tables (catalog, progress, markers) that several jobs update.

    <path>/v=<n>/*.parquet      each version is the whole table; readers take the newest

A new version is staged and then published by an exclusive rename, so of two writers that read the
same version only one succeeds and the other starts again from the newer one, after a short random
wait. Versions go by age, never by number, so a reader keeps what it has begun to read.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logferry.sources.files import AlreadyPublished, Files, fresh_name

#: Seconds for which a version stays after a newer one has come: far longer than any job reads it.
KEPT_SECONDS = 7 * 24 * 3600


class SmallTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        self._files = Files(spark)

    def _latest(self) -> int:
        return max(self._files.numbers(self.path, "v"), default=0)

    def _at(self, version: int) -> DataFrame:
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def read(self) -> DataFrame:
        return self._at(self._latest())

    def update(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Publish ``change(current rows)`` as the next version."""
        wait = 0.05
        while True:
            version = self._latest()
            staged = f"{self.path}/staging-{fresh_name()}"
            change(self._at(version)).write.option("compression", "zstd").parquet(staged)
            try:
                self._files.publish(staged, f"{self.path}/v={version + 1}")
            except AlreadyPublished:
                self._files.delete(staged)
                time.sleep(random.uniform(0, wait))
                wait = min(2.0, 2 * wait)
                continue
            for old in self._files.older(self.path, "v", KEPT_SECONDS):
                if old < version:
                    self._files.delete(f"{self.path}/v={old}")
            return
