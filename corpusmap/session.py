"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusmap")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


@functools.cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="corpusmap-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _test_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as a table in the shared folder, with options of the writer, and read it back.

    Plans of iterative jobs stay short, a lost executor costs no recomputation, and Spark knows
    the size of what it reads, so small sides are broadcast by measure.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.step_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table behind a step that nothing reads any more."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df.step_path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


SMALL_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """A small table over all cores before costly per-row work.

    A small table often is a single file section, hence one task. Larger ones come in many
    sections and stay as they are, so nothing large is shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < SMALL_BYTES else df
