"""Session construction and shared scratch storage.

Every job in the library is a lazy DataFrame plan; the session only carries
configuration.  Two settings matter for correctness rather than speed:

* ``spark.sql.session.timeZone=UTC`` so date/time functions are stable;
* ``spark.sql.sources.partitionOverwriteMode=dynamic`` so an overwrite of a
  partitioned table only replaces the partitions present in the written data
  (the batch-scoped replace of the snapshot tables relies on it).

Scratch data (materialised intermediate tables, round-trip queries) always goes
under the folder the cluster names in ``spark.checkpoint.dir``.  Where it is
unset there is no folder that all executors are known to share, so asking for
one is an error; only a local master, whose executors are this process, gets
one under the warehouse folder.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    # A fused stage whose generated method exceeds 8,000 bytes of bytecode is
    # never JIT-compiled by the JVM and runs interpreted (measured 2.6x slower
    # on the snapshot build).  At this limit Spark splits such a stage back
    # into per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "shelfwise",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings the library depends on in an existing session."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.sources.partitionColumnTypeInference.enabled",
              "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, DEFAULT_CONF[k])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session or the context.  Unset on a local master: a folder
    under the warehouse; unset anywhere else: an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) \
        or context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    root = root.rstrip("/")
    if root.removeprefix("file:").lstrip("/") not in (context.getCheckpointDir() or ""):
        context.setCheckpointDir(root)  # each call makes a folder
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    """(path, its file system): a path without a scheme is on ``fs.defaultFS``,
    wherever that is."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FS reaches any store
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    hpath, fs = _hadoop_path(spark, path)
    fs.delete(hpath, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it is not there); no file is looked at."""
    hpath, fs = _hadoop_path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())


def subpaths(spark: SparkSession, path: str) -> list[str]:
    """Names of all that is in a folder (none if it is not there)."""
    hpath, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file within its file system; its new folder is made if need be."""
    source, fs = _hadoop_path(spark, path)
    target, _ = _hadoop_path(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds since 1970."""
    hpath, fs = _hadoop_path(spark, path)
    return fs.getFileStatus(hpath).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as one text, read by the driver."""
    hpath, fs = _hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")  # noqa: SLF001
    finally:
        stream.close()


def publish_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole text at once; False if there is one.

    The text is written under another name first and then gets its own: by a hard
    link on a local or mounted file system, elsewhere by a rename, which must
    refuse to replace a file (HDFS and stores with atomic renames do).
    """
    hpath, fs = _hadoop_path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(  # noqa: SLF001
        hpath.getParent(), f".{hpath.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(draft.toUri().getPath(), hpath.toUri().getPath())
            return True
        return not fs.exists(hpath) and bool(fs.rename(draft, hpath))
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)


@contextmanager
def scratch_table(df, name: str):
    """``materialize`` for the time of a ``with`` block; the files go at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.mode("overwrite").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def materialize(df, name: str):
    """Cut lineage: write ``df`` as parquet under the shared checkpoint folder
    and read it back.

    Columnar and compressed, and the re-read relation carries real size
    statistics for the planner (an RDD checkpoint scan has none, so joins
    against it cannot be sized).  The files live in shared storage, so a lost
    executor does not lose them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
