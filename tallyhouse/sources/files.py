"""Folders and small files on whatever store a path names, through Hadoop's file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    path, fs = _at(spark, path)
    return fs.exists(path)


def names(spark: SparkSession, root: str, only_folders: bool = False) -> list[str]:
    """What lies in a folder, sorted; nothing if there is no such folder."""
    path, fs = _at(spark, root)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() or not only_folders)


def delete(spark: SparkSession, path: str) -> None:
    path, fs = _at(spark, path)
    fs.delete(path, True)


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a name that must not exist yet; False if it does. One step where the store renames in one."""
    context, jvm = spark.sparkContext, spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    _, fs = _at(spark, target)
    fs.mkdirs(path.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri() if path.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    none = context._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(jvm.org.apache.hadoop.fs.Path(source), path, none)
    except Py4JJavaError as error:
        if fs.exists(path) and "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    path, fs = _at(spark, path)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    path, fs = _at(spark, path)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_text_new(spark: SparkSession, path: str, text: str) -> bool:
    """A file that appears whole or not at all; False if it is there already."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    if move_new(spark, draft, path):
        return True
    delete(spark, draft)
    return False


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another; the old one is set aside, and put back if that fails."""
    aside = f"{target.rstrip('/')}.old-{uuid.uuid4().hex}"
    there = exists(spark, target)
    if there and not move_new(spark, target, aside):
        raise FileExistsError(aside)
    try:
        if not move_new(spark, staged, target):
            raise FileExistsError(f"{target}: another writer was first")
    except BaseException:
        if there and not exists(spark, target):
            move_new(spark, aside, target)
        raise
    if there:
        delete(spark, aside)


def join_files(spark: SparkSession, parts: list[str], target: str) -> None:
    """One file out of parts, in their order: by name where the store can, else copied piece by piece."""
    jvm = spark._jvm
    path, fs = _at(spark, target)
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in parts]
    stream = fs.create(path, False)  # makes the folder as well
    try:
        for part in paths:
            source = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, 1 << 20, False)
            finally:
                source.close()
    finally:
        stream.close()
