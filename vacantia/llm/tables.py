"""Tables that a job writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where that is unset and the session is local."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or conf.get("spark.vacantia.own.checkpoint.dir", None)
    if folder is None:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="vacantia-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def releasing_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """What is written or collected within leaves no shuffle files behind: Spark removes them at the end of the query."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def batches_of(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """What is written within goes to Python in batches of so many rows, where rows are large."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def through_table(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it: lineage ends here, and a lost executor costs no upstream work."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with releasing_shuffles(spark):
        df.write.option("compression", codec).parquet(path)
    spark.sparkContext._jvm.System.gc()  # many short queries: without it their plans fill the driver's heap up to its bound
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def _place(df: DataFrame) -> tuple:
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._written)
    return path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()), path


def size_of(df: DataFrame) -> int:
    """Bytes of a table of through_table()."""
    files, path = _place(df)
    return files.getContentSummary(path).getLength()


def discard(*tables: DataFrame) -> None:
    """Delete tables of through_table() that nothing reads any more."""
    for df in tables:
        files, path = _place(df)
        files.delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
