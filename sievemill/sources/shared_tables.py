"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Paths written within the scopes that are open, the innermost last; each thread has its own scopes.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("_SCOPES", default=())
#: Folders that are deleted when the driver's JVM ends.
_FOLDERS: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, one of our own, if driver and
    executors are one process; on a cluster it is an error, as executors don't see the driver's disk."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="sievemill-")
        spark.conf.set("spark.checkpoint.dir", base)
        _delete_at_the_end(spark, base)
    return base.rstrip("/")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def _delete_at_the_end(spark: SparkSession, folder: str) -> None:
    """Let the file system delete the folder when the driver's JVM ends, whether or not the session was stopped before."""
    make_folder(spark, folder)
    system, p = _file(spark, folder)
    system.deleteOnExit(p)
    _FOLDERS.add(folder)


def new_path(spark: SparkSession, name: str) -> str:
    """A path for a table in the application's own folder, which goes when the driver ends; a scope that is open deletes it sooner."""
    folder = f"{shared_dir(spark)}/sievemill-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _delete_at_the_end(spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut the lineage: write ``df`` as a Parquet table in the shared folder and read it back. A lost executor then costs a
    reread, not the steps before."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system the path names."""
    system, p = _file(spark, path)
    return system.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    system, p = _file(spark, path)
    stream = system.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _write(system, p, text: str) -> None:
    stream = system.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place, then put it there: a reader sees the old text or the new one. File systems that can
    rename over a file do it in one step; with others the new file alone may stand for a moment, which ``read_saved`` knows."""
    system, p = _file(spark, path)
    new = _file(spark, f"{path}.new")[1]
    _write(system, new, text)
    hadoop, gateway = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    over = gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    try:
        hadoop.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, p, over)
        return
    except Py4JJavaError:
        pass
    system.delete(p, False)
    if not system.rename(new, p):
        raise OSError(f"cannot write {path}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that does not exist yet, all at once; whether it was there not."""
    system, p = _file(spark, path)
    new = _file(spark, f"{path}.{uuid.uuid4().hex}")[1]
    _write(system, new, text)
    hadoop, gateway = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    try:
        hadoop.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, p, gateway.new_array(hadoop.Options.Rename, 0))
        return True
    except Py4JJavaError:  # it is there
        system.delete(new, False)
        if not system.exists(p):
            raise
        return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that no scope knows."""
    system, p = _file(spark, path)
    system.delete(p, True)


def read_saved(spark: SparkSession, path: str) -> str | None:
    """The text that ``write_text`` left, also where it was stopped before its last step; null if there is none."""
    for place in (path, f"{path}.new"):
        if exists(spark, place):
            return read_text(spark, place)
    return None


def make_folder(spark: SparkSession, path: str) -> None:
    system, p = _file(spark, path)
    system.mkdirs(p)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that no later plan reads."""
    for path in paths:
        system, p = _file(spark, path)
        system.delete(p, True)
        for made in _SCOPES.get():
            if path in made:
                made.remove(path)


@contextmanager
def only(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Delete all tables written within the block but those that ``keep(df, path)`` names: results that a later plan reads. A scope
    around this one deletes those in its turn, unless it keeps them too. Scopes of other threads are not touched."""
    made: list[str] = []
    kept: list[str] = []
    outer = _SCOPES.get()
    token = _SCOPES.set((*outer, made))

    def keep(df: DataFrame, path: str) -> DataFrame:
        kept.append(path)
        return df

    try:
        yield keep
    finally:
        _SCOPES.reset(token)
        remove(spark, *[p for p in made if p not in kept])
        if outer:
            outer[-1].extend(kept)
