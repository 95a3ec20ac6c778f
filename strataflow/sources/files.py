"""Small text files and renames on the shared file system: the markers that switch tables."""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from strataflow.session import file_system


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a path that does not exist yet; its parent folder is made."""
    fs, old = file_system(spark, source)
    new = file_system(spark, target)[1]
    if fs.exists(new):
        raise FileExistsError(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole; it must not be there yet."""
    fs, hadoop_path = file_system(spark, path)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


@contextlib.contextmanager
def lease(spark: SparkSession, path: str, number: int, hours: float) -> Iterator[None]:
    """Mark a version of the table at `path` as being read while the block runs, `hours` at most."""
    mark = f"{path}/_leases/{number:08d}-{int(time.time() + hours * 3600)}-{uuid.uuid4().hex[:8]}"
    write_text(spark, mark, "")
    try:
        yield
    finally:
        remove(spark, mark)


def leased(spark: SparkSession, path: str) -> set[int]:
    """The versions that are being read; leases that have run out, of readers that died, are taken away."""
    held = set()
    for name in child_names(spark, f"{path}/_leases"):
        number, until, _ = name.split("-")
        if int(until) < time.time():
            remove(spark, f"{path}/_leases/{name}")
        else:
            held.add(int(number))
    return held
