"""Intermediate tables: written once as Parquet below the shared checkpoint folder, and read again.

A table that is read twice is computed once, lineage stays short, and a lost executor loses none of it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`. Unset, a session in one process gets one of its own; a cluster needs one that all share."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="scratch-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Rows of an Arrow batch, at most, where a row may hold a chromosome's alignment.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """`df`; its session hands rows to Python in batches of `BATCH_ROWS` at most."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def even_tasks(df: DataFrame) -> DataFrame:
    """`df` dealt evenly to as many tasks as a shuffle has: for small rows that take long, which would share few tasks by their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


_SCOPES: list[list[Scratch]] = []


@contextmanager
def scope() -> Iterator[None]:
    """All tables that operators make inside are deleted behind it: for callers that write a result inside."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for s in _SCOPES.pop():
            s.sweep()


class Scratch:
    """Tables of one run of an operator. `sweep` deletes them once its result is written elsewhere."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        if _SCOPES:
            _SCOPES[-1].append(self)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """`df` written as a table and read again."""
        at = self.path(name)
        df.write.option("compression", "zstd").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def counted(self, df: DataFrame, name: str, of: Column | None = None) -> tuple[DataFrame, int]:
        """As `keep`, with the number of rows, or another total `of` them, counted while they are written."""
        seen = Observation()
        out = self.keep(df.observe(seen, (F.count(F.lit(1)) if of is None else of).alias("n")), name)
        return out, int(seen.get["n"])

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files of tables that no later step reads."""
        for df in frames:
            for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
                if f.startswith(self.root) or f.replace("file:///", "file:/").startswith(self.root.replace("file:///", "file:/")):
                    self._delete(f)

    def sweep(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
