"""The few file-system calls Spark has no DataFrame for: rename, exists, tiny text files."""

from __future__ import annotations

import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Visible children of a folder, sorted; empty when the folder is absent."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since the file or folder was last changed."""
    fs, target = _open(spark, path)
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _open(spark, source)
    _, dst = _open(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise FileExistsError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small file in one step: readers see all of it or nothing. Of several writers of one path
    exactly one succeeds; the others get ``FileExistsError``."""
    draft = re.sub(r"([^/]+)$", rf"_\1.{uuid.uuid4().hex}", path)
    fs, source = _open(spark, draft)
    _, target = _open(spark, path)
    stream = fs.create(source, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        _publish(spark, fs, source, target)
    finally:
        if fs.exists(source):
            fs.delete(source, False)


def _publish(spark: SparkSession, fs, source, target) -> None:
    """Give the file its final name unless that is taken, as one step of the file system."""
    if fs.getScheme() == "file":
        # A local rename would replace what is there; a second name for the file cannot.
        local = [spark._jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (source, target)]
        try:
            spark._jvm.java.nio.file.Files.createLink(local[1], local[0])
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            raise FileExistsError(f"{target} is there already") from None
    elif fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(f"{target} is there already")


def qualified(spark: SparkSession, path: str) -> str:
    """Scheme, host and absolute path in one spelling, with ``.`` and ``..`` resolved."""
    fs, target = _open(spark, path)
    uri = fs.makeQualified(target).toUri().normalize()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def literal(path: str) -> str:
    """Escape glob characters, so that a listed file name is read as that one file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
