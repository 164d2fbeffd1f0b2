"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from functools import cache

from pyarrow import ArrowException, fs
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerloom", cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors reach: spark.checkpoint.dir of the session.

    Only where the setting is absent and the session is local (tests, a laptop)
    a folder of the machine is made, once a process; on a cluster its absence is
    an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(?:\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors reach")
        where = _local_dir()
    return where.rstrip("/")


#: The folders of this process's intermediate tables that haven't been deleted yet.
_WRITTEN: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted by `clear` or when the process ends."""
    path = f"{shared_dir(spark)}/ledgerloom/{label}-{uuid.uuid4().hex}"
    _WRITTEN.add(path)
    return path


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage ends there.

    The files outlive a lost executor. Parquet is kept rather than RDD
    checkpoint files: it is columnar, compressed and gives Catalyst sizes.
    """
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(path: str) -> None:
    """Delete a folder; one that can't be reached any more is left."""
    _WRITTEN.discard(path)
    try:
        system, root = fs.FileSystem.from_uri(path)
        system.delete_dir(root)
    except (OSError, ArrowException):
        pass


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a DataFrame that `cut` returned and nothing reads any more."""
    names = {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}
    for path in [p for p in _WRITTEN if os.path.basename(p) in names]:
        _delete(path)


def clear() -> None:
    """Delete all intermediate tables of this process; results that read them must have been used."""
    for path in list(_WRITTEN):
        _delete(path)


atexit.register(clear)


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores, for costly row-wise work, where a small input has fewer partitions than that.

    Inputs of as many splits as cores and more are left as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a DataFrame that `cut` returned and nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for root in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)


def reach_workers(spark: SparkSession) -> None:
    """Ship this package to the executors, once a session."""
    context = spark.sparkContext
    if any(os.path.basename(f).startswith("ledgerloom-") for f in context.listFiles):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # The driver serves the archive to the executors, so it stays as long as the process.
    folder = tempfile.mkdtemp(prefix="ledgerloom-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"ledgerloom-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for at, _, names in os.walk(root):
            for name in (n for n in names if n.endswith(".py")):
                path = os.path.join(at, name)
                z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
