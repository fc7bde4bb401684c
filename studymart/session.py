"""Session settings the jobs rely on, and the shared scratch folder."""

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str, master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC; the cluster decides the rest.

    Every setting can be overridden by ``conf`` (dots written as double underscores)
    or by spark-submit. The shuffle partition count is left alone on a cluster: with
    adaptive execution it is only the starting point that gets coalesced.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.lru_cache(maxsize=1)
def _local_base(application: str) -> str:
    """One temporary folder for all of a local application's scratch, removed when Python ends."""
    base = tempfile.mkdtemp(prefix="studymart-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, removed when the application ends.

    It lies under the folder that ``spark.checkpoint.dir`` names, which every executor
    can reach. Only a local master may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base(spark.sparkContext.applicationId)
    path = f"{base.rstrip('/')}/studymart-{uuid.uuid4().hex}/{name}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def materialise(df, name: str):
    """Write a frame to the scratch folder once and read it back.

    Cuts the lineage before work that would otherwise run the frame twice, such as the
    sampling pass of a range sort over an expensive column. Unlike a cache it survives
    the loss of executors, and unlike ``checkpoint()`` the copy is columnar.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
