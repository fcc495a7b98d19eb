"""Written intermediate tables: the one way this library cuts lineage.

`keep` writes a DataFrame as Parquet below the shared folder that the cluster names in `spark.checkpoint.dir` and reads
it back. The files survive the loss of any executor, and what reads them plans from their real size. Where the setting
is absent a temporary folder is used if all tasks run in this process; a cluster without the setting is an error, for its
workers would write to disks that no other sees.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share; a machine-local one only where the master is local and the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all workers of {master} share")
    if "root" not in _local:
        _local["root"] = tempfile.mkdtemp(prefix="marl-")
        atexit.register(shutil.rmtree, _local["root"], ignore_errors=True)
    return "file://" + _local["root"]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing uses yet; it is removed when the driver ends."""
    path = f"{shared_root(spark)}/marl-{label}-{uuid.uuid4().hex}"
    atexit.register(_quiet_delete, spark, path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that `fresh_path` named."""
    files, target = _hadoop_path(spark, path)
    files.delete(target, True)


def _quiet_delete(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            delete(spark, path)
    except Exception:  # the session has ended: the folder's owner cleans up
        pass


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop_path(spark, path)
    return files.exists(target)


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """The names in a folder with the time, in milliseconds, of their last change; none for a folder that is not there."""
    files, target = _hadoop_path(spark, path)
    return {f.getPath().getName(): f.getModificationTime() for f in files.listStatus(target)} if files.exists(target) else {}


def create_once(spark: SparkSession, path: str, data: bytes) -> bool:
    """Publish a small file whole and in one step unless `path` is there already; whether it did.

    The content is written beside it and moved by a rename that refuses an existing target (a hard link on a local disk), so
    that of several writers one succeeds and no reader sees a part.
    """
    files, target = _hadoop_path(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}"
    write_bytes(spark, beside, data)
    try:
        if files.getUri().getScheme() == "file":
            plain = lambda p: p.removeprefix("file://") if p.startswith("file:///") else p.removeprefix("file:")
            os.link(plain(beside), plain(path))
        else:
            gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
            how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(jvm.org.apache.hadoop.fs.Path(beside), target, how)
        return True
    except FileExistsError:
        return False
    except Exception:
        if files.exists(target):
            return False
        raise
    finally:
        delete(spark, beside)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The content of a small file."""
    files, target = _hadoop_path(spark, path)
    stream = files.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file through the file system of `path`."""
    files, target = _hadoop_path(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and return it as read from there."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._marl_path = path
    return kept


def drop(*frames: DataFrame) -> None:
    """Delete the files behind frames that `keep` returned and that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_marl_path", None)
        if path:
            delete(df.sparkSession, path)
