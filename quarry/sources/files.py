"""Small files on any store that Spark reaches: manifests, reports, signatures. Nothing here grows with the data."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def is_dir(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder."""
    place, system = _place(spark, path)
    return sorted(x.getPath().getName() for x in system.listStatus(place)) if system.exists(place) else []


def rename(spark: SparkSession, folder: str, suffix: str, other: str) -> None:
    """Gives files directly under a folder another suffix: Spark's writers choose their own."""
    place, system = _place(spark, folder)
    for x in system.listStatus(place):
        name = x.getPath().getName()
        if name.endswith(suffix) and not name.startswith((".", "_")):
            system.rename(x.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, name.removesuffix(suffix) + other))


def signature(spark: SparkSession, path: str) -> str:
    """path:size:mtime, what a cached result was made from; of a folder, its own."""
    place, system = _place(spark, path)
    found = system.getFileStatus(place)
    return f"{path}:{found.getLen()}:{found.getModificationTime()}"


def size(spark: SparkSession, path: str) -> int:
    place, system = _place(spark, path)
    return system.getFileStatus(place).getLen()


def read_bytes(spark: SparkSession, path: str, offset: int = 0, length: int | None = None) -> bytes:
    """A small file, or a slice of any file."""
    place, system = _place(spark, path)
    size = system.getFileStatus(place).getLen() - offset
    stream = system.open(place)
    try:
        stream.seek(offset)
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(min(size, size if length is None else length))))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return read_bytes(spark, path).decode("utf-8-sig")


def write_text(spark: SparkSession, path: str, parts: str | Iterable[str]) -> None:
    """Written aside and renamed, so that no half a file is ever seen."""
    place, system = _place(spark, path)
    aside = place.suffix(".tmp")
    stream = system.create(aside, True)
    try:
        for part in [parts] if isinstance(parts, str) else parts:
            stream.write(bytearray(part.encode("utf-8")))
    except BaseException:
        stream.close()
        system.delete(aside, False)
        raise
    stream.close()
    if system.exists(place):
        system.delete(place, False)
    if not system.rename(aside, place):
        raise OSError(f"can't write {path}")


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a new file whole, in one step that only one of several writers can win; False where it is there already.

    Local and shared folders: written aside and linked. Other stores: written aside and renamed without overwriting, which
    is one step where the store's renames are (object stores need a file system whose renames are conditional).
    """
    place, system = _place(spark, path)
    jvm = spark.sparkContext._jvm
    if system.exists(place):
        return False
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            at = lambda p: jvm.java.nio.file.Paths.get(system.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(at(place), at(aside))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(aside, place, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(aside, False)
