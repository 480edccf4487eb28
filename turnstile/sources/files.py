"""Small files that say what is current, through Hadoop's file interface: they lie wherever the tables do.

A text appears under its name whole or not at all: it is written beside it and renamed.  ``replace=False`` makes the rename
fail if the name is there, which lets one of several writers win.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class AlreadyThere(RuntimeError):
    """Another writer was first."""


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return jvm, fs, fs.makeQualified(found)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    _, fs, path = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    _, fs, at = _path(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool) -> None:
    jvm, fs, final = _path(spark, path)
    fs.mkdirs(final.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(rename, int(replace))
    if replace:
        how[0] = rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, how)
    except Exception as error:
        fs.delete(draft, False)
        if not replace and fs.exists(final):
            raise AlreadyThere(path) from error
        raise
