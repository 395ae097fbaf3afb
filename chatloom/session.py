"""Session helpers: test sessions, table access and durable intermediate results."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, name: str = "chatloom") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data directory holding one Parquet file or folder per table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; where that is unset, a temporary one of a local master, and an
    error on a cluster, whose executors wouldn't find it."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"chatloom-{uuid.uuid4().hex}")
    sc.setCheckpointDir(own)
    return sc._jsc.sc().getCheckpointDir().get()


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a compressed table into the shared folder and read it again.

    Cuts the lineage so that a lost executor costs no recomputation, and lets several later steps scan the same rows.
    The files are removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/chatloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = staged.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` on all cores: a plain scan of fewer partitions than cores is repartitioned, anything else stays as it is.

    For stages that cost far more than moving their input; a large table has more partitions than cores and isn't moved.
    """
    context = df.sparkSession.sparkContext
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df.repartition(context.defaultParallelism) if df.rdd.getNumPartitions() < context.defaultParallelism else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="chatloom-ship-")  # the driver serves the archive from here
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "chatloom"), "zip", os.path.dirname(root), os.path.basename(root)))
    _SHIPPED.add(app)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
