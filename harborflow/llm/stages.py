"""Written intermediate tables that can be removed as soon as no later step reads them."""

from __future__ import annotations

import gc
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from harborflow.session import new_path


# Rows of whole texts: smaller Arrow batches bound what a task holds outside the heap and in its Python worker.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
# For tasks that make many numbers of every byte: short rows still come in batches of as many.
SMALL_BATCHES = ARROW_CONF | {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}
# Whether shuffle files go when the query ends that wrote them (from Spark 4.1 on; others take no notice).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stages:
    """Tables of one operator run under the folder that `spark.checkpoint.dir` names."""

    def __init__(self, spark: SparkSession, label: str, conf: dict[str, str] = ARROW_CONF):
        self.spark, self.label = spark, label
        for key, value in conf.items():
            spark.conf.set(key, value)
        self.paths: dict[int, str] = {}
        self.there: set[str] = set()

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, f"{self.label}-{name}")
        self.there.add(path)
        self._write(df, path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def _write(self, df: DataFrame, path: str) -> None:
        """What is shuffled for the rows is removed as soon as they are written. Without that it stays until the driver has collected
        the plan, and the last plan is still held when `clean` is called."""
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more, and let Spark clean the shuffles behind them."""
        self._remove(self.paths.pop(id(table)) for table in tables)

    def keep(self, *tables: DataFrame) -> None:
        """Remove all tables but these: nothing reads the others any more."""
        self._remove(self.there - {self.paths[id(table)] for table in tables})

    def _remove(self, paths: Iterable[str]) -> None:
        for name in paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.there.discard(name)
        self.clean()

    def clean(self) -> None:
        """Shuffle files of other queries go when the driver has collected the plans that own them."""
        gc.collect()
        self.spark._jvm.System.gc()
