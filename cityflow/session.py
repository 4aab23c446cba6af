"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Zone-less timestamps are read as UTC everywhere, so results do not depend on the cluster's zone.
_SQL_SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library's results depend on. Sizing is left to the cluster and AQE."""
    for name, value in _SQL_SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def build(app_name: str = "cityflow", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is taken in local mode only; on a cluster a folder of
    one machine would be lost with it, so that is an error. Spark's checkpoint folder is set too.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="cityflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/cityflow/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def _located(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def children(spark: SparkSession, path: str) -> list[str]:
    """The files and folders in a folder, none if it does not exist."""
    system, folder = _located(spark, path)
    return [status.getPath().toString() for status in system.listStatus(folder)] if system.exists(folder) else []


def found(spark: SparkSession, path: str) -> bool:
    """Whether there is such a path; it may be a pattern."""
    system, wanted = _located(spark, path)
    return bool(system.globStatus(wanted))


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, decompressed as its name says."""
    jvm = spark.sparkContext._jvm
    system, location = _located(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(location)
    stream = system.open(location)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    system, unwanted = _located(spark, path)
    system.delete(unwanted, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this process has written under its scratch paths, once its results are stored."""
    while _made:
        delete(spark, _made.pop())
