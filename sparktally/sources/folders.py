"""Files and folders through Hadoop's file systems, on the driver; names only, no data."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

# Headers that are read at once.
READERS = 16


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, a local session gets a temporary folder; a cluster is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sparktally-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/sparktally/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def files_in(spark: SparkSession, path: str, files: str = "*") -> list[str]:
    """The files of a folder, or the file itself, in order of their names; no hidden ones."""
    folder, system = hadoop_path(spark, path)
    if not system.isDirectory(folder):
        return [path]
    matching = spark._jvm.org.apache.hadoop.fs.Path(folder, files)
    found = [status for status in system.globStatus(matching) if status.isFile()]
    names = [status.getPath() for status in found if status.getLen() > 0]
    return sorted(p.toString() for p in names if not p.getName().startswith(("_", ".")))


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a file, unpacked if its name says that it is compressed."""
    path, system = hadoop_path(spark, file)
    jvm = spark._jvm
    stream = system.open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(system.getConf()).getCodec(path)
        unpacked = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(unpacked, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: list[str]) -> list[str]:
    """The first line of each file: one small read a file, several at a time."""
    with ThreadPoolExecutor(READERS) as pool:
        return list(pool.map(lambda file: first_line(spark, file), files))


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Renames a folder; the new name must not exist."""
    source, system = hadoop_path(spark, old)
    target, _ = hadoop_path(spark, new)
    if system.exists(target):
        raise FileExistsError(new)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"{old} could not be renamed to {new}")
