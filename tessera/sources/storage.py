"""Where intermediate results go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where that is unset a local session gets a temporary folder; on a cluster, whose machines share no
    such folder, that is refused."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = current.get() if current.isDefined() else None
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Tables:
    """Intermediate tables in the shared folder. Writing one cuts lineage, and a lost executor loses nothing; `drop` deletes what has been superseded."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def saved(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/tessera/table-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        """Delete all tables but the last `keep`."""
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.paths = self.paths[len(gone) :]


def cut(df: DataFrame) -> DataFrame:
    """A frame written to the shared folder and read again."""
    return Tables(df.sparkSession).saved(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
