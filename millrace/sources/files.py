"""Files next to Spark's readers: path listing, streamed reads and writes inside tasks."""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 8 * 1024 * 1024


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, from the file system itself."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return [status.getPath().toString() for status in found] if found else []


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    return bool(list_files(spark, pattern))


def glob_paths(spark: SparkSession, pattern: str) -> DataFrame:
    """One row (path) per file matching the glob. Names only; no content reaches the driver.

    Spark's own readers hide names that start with an underscore, so the listing asks the file system.
    """
    paths = list_files(spark, pattern)
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = max(1, min(len(paths) // 64, spark.sparkContext.defaultParallelism * 4))
    return listing.repartition(tasks) if tasks > 1 else listing.coalesce(1)


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def list_modified(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, time of change in milliseconds) of what matches a glob."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return [(s.getPath().toString(), s.getModificationTime()) for s in found] if found else []


def glob_stats(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, modified, bytes) of the files that match a glob, from the file system's listing; no content is read."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    return spark.createDataFrame([(s.getPath().toString(), s.getModificationTime(), s.getLen()) for s in found],
                                 "path string, modified bigint, bytes bigint")


def read_small(spark: SparkSession, path: str) -> str:
    """The text of one small control file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates one small control file whole, or returns False if it exists: written aside, then renamed without
    overwriting, so nobody sees half of it and only one of several writers gets the name."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(aside)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(target), options)
    except Py4JJavaError as failed:
        if not system.exists(target):
            raise
        system.delete(aside, False)
        if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def opener():
    """uri -> (Arrow file system, path), for use inside tasks.

    A nested function travels to the executors with its task, so they need Arrow but not this package.
    """
    def open_filesystem(uri: str):
        from urllib.parse import unquote, urlparse

        from pyarrow import fs

        parsed = urlparse(uri)
        if parsed.scheme in ("", "file"):
            return fs.LocalFileSystem(), unquote(parsed.path)
        return fs.FileSystem.from_uri(uri)
    return open_filesystem


def read_texts(paths: DataFrame) -> DataFrame:
    """(path, text) of small control files, read on the executors."""
    locate = opener()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for uri in batch["path"]:
                filesystem, path = locate(uri)
                with filesystem.open_input_stream(path) as stream:
                    texts.append(stream.read().decode("utf-8", "replace"))
            yield pd.DataFrame({"path": batch["path"], "text": texts})
    return paths.select("path").mapInPandas(read, "path string, text string")


def digests(paths: DataFrame) -> DataFrame:
    """(path, sha256, bytes), hashed in chunks so that file size does not matter; NULLs for a missing file."""
    locate = opener()

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for uri in batch["path"]:
                filesystem, path = locate(uri)
                sha, size = hashlib.sha256(), 0
                try:
                    with filesystem.open_input_stream(path) as stream:
                        while chunk := stream.read(CHUNK):
                            sha.update(chunk)
                            size += len(chunk)
                    found.append((uri, sha.hexdigest(), size))
                except FileNotFoundError:
                    found.append((uri, None, None))
            yield pd.DataFrame(found, columns=["path", "sha256", "bytes"]).astype({"bytes": "Int64"})
    return paths.select("path").mapInPandas(digest, "path string, sha256 string, bytes bigint")


def file_name(path) -> F.Column:
    return F.substring_index(path, "/", -1)
