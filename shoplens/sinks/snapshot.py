"""Snapshot tables with versioned pointer files.

Layout: ``{root}/snapshots/{id}/`` holds data; ``{root}/_CURRENT.{n}`` names a
snapshot, and the highest n is live. Publishing writes the data completely,
then the next pointer under a temporary name, then renames it: no step removes
or replaces the live pointer, so a reader or a restart between any two steps
finds the old or the new version. The first publish starts with pointer 0, the
empty table; snapshots without any pointer are therefore damage and an error,
never an empty table. After the switch, pointers older than the previous one
and snapshots that no kept pointer names are removed.

One writer per table; a second writer loses the rename and fails. Works on any
Hadoop-compatible file system through the JVM FileSystem API.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = re.compile(r"_CURRENT\.(\d+)$")
KEPT = 2  # the live version and the one before, which a running reader may hold


class SnapshotError(RuntimeError):
    """A table's pointers are missing or a publish lost against another."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the pointers, ascending."""
    found = sorted(int(m[1]) for m in map(POINTER.match, names(spark, root)) if m)
    if not found and names(spark, f"{root.rstrip('/')}/snapshots"):
        raise SnapshotError(f"{root} holds snapshots but no pointer to one")
    return found


def read_pointer(spark: SparkSession, root: str, n: int) -> str:
    return read_text(spark, f"{root.rstrip('/')}/_CURRENT.{n}")


def _pointer(spark: SparkSession, root: str, n: int) -> tuple[str | None, str | None]:
    snap, _, tag = read_pointer(spark, root, n).partition("\t")
    return snap or None, tag or None


def current_info(spark: SparkSession, root: str) -> tuple[str, str | None] | None:
    """(snapshot id, tag) of the live snapshot, or None."""
    have = versions(spark, root)
    if not have:
        return None
    snap, tag = _pointer(spark, root, have[-1])
    return None if snap is None else (snap, tag)


def current(spark: SparkSession, root: str) -> str | None:
    info = current_info(spark, root)
    return None if info is None else info[0]


def read_current(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    snap = current(spark, root)
    return None if snap is None else spark.read.format(fmt).load(f"{root.rstrip('/')}/snapshots/{snap}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file; an error if the target exists."""
    fs, old = _fs(spark, source)
    _, new = _fs(spark, target)
    if fs.exists(new) or not fs.rename(old, new):
        raise SnapshotError(f"{target} exists or cannot be written")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all; an error if it
    exists."""
    folder = path.rpartition("/")[0]
    fs, tmp = _fs(spark, f"{folder}/_tmp.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    move(spark, tmp.toString(), path)


def _point(spark: SparkSession, root: str, n: int, text: str) -> None:
    try:
        write_text(spark, f"{root.rstrip('/')}/_CURRENT.{n}", text)
    except SnapshotError as e:
        raise SnapshotError(f"another writer published version {n} of {root}") from e


def publish_pointer(spark: SparkSession, root: str, text: str) -> None:
    """Makes ``text`` (one line) the table's next pointer; the first one
    follows pointer 0, the empty table."""
    have = versions(spark, root)
    if not have:
        _point(spark, root, 0, "")
        have = [0]
    _point(spark, root, have[-1] + 1, text)


def remove_pointers(spark: SparkSession, root: str) -> None:
    """Removes the pointers before the last KEPT ones."""
    for n in versions(spark, root)[:-KEPT]:
        fs, p = _fs(spark, f"{root.rstrip('/')}/_CURRENT.{n}")
        fs.delete(p, False)


def _remove_superseded(spark: SparkSession, root: str) -> None:
    kept = {_pointer(spark, root, n)[0] for n in versions(spark, root)[-KEPT:]}
    remove_pointers(spark, root)
    for name in names(spark, f"{root.rstrip('/')}/snapshots"):
        if name not in kept:
            fs, p = _fs(spark, f"{root.rstrip('/')}/snapshots/{name}")
            fs.delete(p, True)


def publish_snapshot(spark: SparkSession, df: DataFrame, root: str, fmt: str = "parquet",
                     tag: str | None = None) -> str:
    """Write ``df`` as a new snapshot and make it live."""
    have = versions(spark, root)
    if not have:
        _point(spark, root, 0, "")
        have = [0]
    snap = uuid.uuid4().hex
    df.write.format(fmt).mode("errorifexists").save(f"{root.rstrip('/')}/snapshots/{snap}")
    _point(spark, root, have[-1] + 1, snap if tag is None else f"{snap}\t{tag}")
    _remove_superseded(spark, root)
    return snap
