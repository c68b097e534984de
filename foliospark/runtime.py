"""Session helpers shared by every operator: table access, lineage cuts, size checks."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "foliospark", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Unset on a local master (tests): a fresh temp folder is taken. Unset on a
    cluster: an error, since a machine-local folder would lose data there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # The setting can't be changed in a running session, so the folder is kept here.
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="foliospark-")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a
    lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/foliospark/{tag}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def bounded(df: DataFrame, rows: int) -> bool:
    """True if df has at most so many rows: the check made before a broadcast."""
    return df.limit(rows + 1).count() <= rows


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fmt_double(c, digits: int = 6):
    """Round for comparisons; minus zero becomes zero."""
    return F.round(c, digits) + F.lit(0.0)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in any file system that Spark can reach; no error if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
