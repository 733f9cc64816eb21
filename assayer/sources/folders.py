"""The ``name=value`` folders of a table, and replacing some of them so that a crash leaves nothing half done.

Spark's own overwriting of single partitions deletes the old folder and moves the new one in its place
when the write is committed, and folders that have become empty would have to be deleted in a step of
their own. Here new folders are first written beside the table's, then a note says which folders are to
be moved in and which are to go, and only then they are moved. Whoever next writes to the table, or
calls ``finish_replacing``, carries out a note that was left. Before the note the table is as it was;
after it, repeating the moves gives the same table, however far they had come.

A table may have one writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Folders that begin with an underscore are no part of a table.
PENDING, NOTE = "_replacing", "_note.json"
# Fixed value: the name of the folder for null.
NULL = "__HIVE_DEFAULT_PARTITION__"
_MOVES_AT_ONCE = 16

Day = tuple[object, ...]


@dataclass(frozen=True)
class Replaced:
    """Folders that were put in place and folders that went, relative to the table."""

    put: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    files, at = file_system(spark, path)
    files.delete(at, True)


def folder_name(partition_by: Sequence[str], day: Sequence[object]) -> str:
    return "/".join(f"{name}={NULL if value is None else value}" for name, value in zip(partition_by, day, strict=True))


def folder_values(folder: str) -> tuple[str | None, ...]:
    values = [part.split("=", 1)[1] for part in folder.split("/")]
    return tuple(None if v == NULL else v for v in values)


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    files, at = file_system(spark, pattern)
    jvm = spark.sparkContext._jvm
    found = files.globStatus(at)
    if not found:
        return []
    # One call for all names.
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
    return jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\n").split("\n")


def _literal(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path.rstrip("/"))


def existing_folders(spark: SparkSession, path: str, partition_by: Sequence[str]) -> list[str]:
    """The folders of a table, relative to it."""
    found = _listed(spark, "/".join([_literal(path), *[f"{name}=*" for name in partition_by]]))
    return sorted("/".join(p.rstrip("/").split("/")[-len(partition_by) :]) for p in found)


def existing_days(spark: SparkSession, path: str, partition_by: Sequence[str]) -> list[Day]:
    """The folders of a table whose folder columns are numbers, as their values."""
    folders = existing_folders(spark, path, partition_by)
    return [tuple(None if v is None else int(v) for v in folder_values(f)) for f in folders]


def _write_note(spark: SparkSession, beside: str, note: dict) -> None:
    """The note appears as a whole or not at all."""
    files, draft = file_system(spark, f"{beside}/{NOTE}.draft")
    out = files.create(draft)
    out.write(json.dumps(note).encode())
    out.close()
    _, at = file_system(spark, f"{beside}/{NOTE}")
    if not files.rename(draft, at):
        raise OSError(f"Cannot write {beside}/{NOTE}")


def _read_note(spark: SparkSession, beside: str) -> dict | None:
    files, at = file_system(spark, f"{beside}/{NOTE}")
    if not files.exists(at):
        return None
    stream = files.open(at)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _carry_out(spark: SparkSession, path: str, beside: str, note: dict, again: bool = True) -> None:
    """Delete and move as the note says; ``again`` if some of it may have been done already.

    Calls to the file system are few for each folder, since there may be as many as days.
    """
    files, _ = file_system(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    depth = [part.split("=")[0] for part in (note["put"] or note["gone"] or [""])[0].split("/")]
    there = set(existing_folders(spark, path, depth))
    left = set(existing_folders(spark, beside, depth)) if again else set(note["put"])
    for parent in sorted({folder.rpartition("/")[0] for folder in left}):
        files.mkdirs(at(f"{path}/{parent}"))

    def gone(folder: str) -> None:
        files.delete(at(f"{path}/{folder}"), True)

    def put(folder: str) -> None:
        _move(files, at(f"{beside}/{folder}"), at(f"{path}/{folder}"), folder in there)

    with ThreadPoolExecutor(_MOVES_AT_ONCE) as pool:
        list(pool.map(gone, there.intersection(note["gone"])))
        list(pool.map(put, [folder for folder in note["put"] if folder in left]))
    delete(spark, beside)


def _move(files, source, target, occupied: bool) -> None:
    if occupied:
        files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"Cannot move {source} to {target}")


def add_files(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have ``write`` write beside, and move its files into the folder. Several jobs may do so at a time,
    which Spark's own appending does not allow."""
    beside = f"{path.rstrip('/')}/_adding-{uuid.uuid4().hex}"
    write(beside)
    for file in _listed(spark, f"{_literal(beside)}/part-*"):
        files, at = file_system(spark, file)
        _, target = file_system(spark, f"{path.rstrip('/')}/{file.split('/')[-1]}")
        if not files.rename(at, target):
            raise OSError(f"Cannot move {file} to {path}")
    delete(spark, beside)


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Carry out what a run that broke off has noted; what it had not noted yet goes."""
    path = path.rstrip("/")
    if not exists(spark, f"{path}/{PENDING}"):
        return
    for found in _listed(spark, f"{_literal(path)}/{PENDING}/*"):
        beside = f"{path}/{PENDING}/{found.rstrip('/').split('/')[-1]}"
        note = _read_note(spark, beside)
        if note is None:
            delete(spark, beside)
        else:
            _carry_out(spark, path, beside, note)
    delete(spark, f"{path}/{PENDING}")


def replace_folders(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    write: Callable[[str], None],
    emptied: Iterable[str] = (),
) -> Replaced:
    """Have ``write`` write a table beside, and move its folders in place of the table's.

    ``emptied`` names folders that go if nothing was written for them. ``write`` may read the table.
    """
    path = path.rstrip("/")
    finish_replacing(spark, path)
    beside = f"{path}/{PENDING}/{uuid.uuid4().hex}"
    write(beside)
    put = existing_folders(spark, beside, partition_by)
    gone = sorted(set(emptied) - set(put))
    note = {"put": put, "gone": gone}
    _write_note(spark, beside, note)
    _carry_out(spark, path, beside, note, again=False)
    delete(spark, f"{path}/{PENDING}")
    return Replaced(tuple(put), tuple(gone))
