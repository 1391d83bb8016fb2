"""Snapshots: several tables that change together.

A snapshot is a small JSON file that names, for every table, the folders of its parts. Folders
are written once and never changed; a new state of the tables is new folders, then one new
snapshot file. Snapshots are numbered, and the file with the highest number counts. It appears
whole or not at all, and only if no other writer took the number, so readers see all tables of
one state, whatever happened to a writer on the way.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from landfall.sources.files import read_table
from landfall.sources.sinks import hadoop

FOLDER = "_snapshots"
FILE = re.compile(r"(\d{12})\.json")


class ConcurrentChangeError(RuntimeError):
    """Another writer published a snapshot since this one's work began."""


@dataclass
class Snapshot:
    """``tables``: for each table its parts, key to folder, relative to the lake's root.
    ``notes``: what a writer wants to find again, as JSON."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def parts(self, table: str) -> dict[str, str]:
        return self.tables.get(table, {})

    def next(self) -> Snapshot:
        """A copy to change and publish."""
        copy = json.loads(json.dumps([self.tables, self.notes]))
        return Snapshot(self.number + 1, *copy)

    def folders(self) -> set[str]:
        return {folder for parts in self.tables.values() for folder in parts.values()}


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, files = hadoop(spark, f"{root}/{FOLDER}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(m[1]) for m in map(FILE.fullmatch, names) if m)


def _load(spark: SparkSession, root: str, number: int) -> Snapshot:
    path, files = hadoop(spark, f"{root}/{FOLDER}/{number:012d}.json")
    stream = files.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return Snapshot(**json.loads(text))


def current(spark: SparkSession, root: str) -> Snapshot:
    """The published snapshot; an empty one if there is none."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else Snapshot()


def publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` the current one.

    The text is written beside and renamed, which neither replaces a file nor shows a part of one.
    """
    text = json.dumps(
        {"number": snapshot.number, "tables": snapshot.tables, "notes": snapshot.notes}
    )
    name = f"{root}/{FOLDER}/{snapshot.number:012d}.json"
    draft, files = hadoop(spark, f"{root}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    final, _ = hadoop(spark, name)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.toUri() if final.toUri().getScheme() else files.getUri(),
        spark.sparkContext._jsc.hadoopConfiguration(),
    )
    plain = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, final, plain)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise ConcurrentChangeError(f"snapshot {snapshot.number} exists already") from error
        raise


def new_folder(table: str) -> str:
    """A folder, relative to the root, that no snapshot names yet."""
    return f"{table}/{uuid.uuid4().hex}"


def read_folders(
    spark: SparkSession, root: str, folders: Iterable[str], schema: StructType
) -> DataFrame:
    """The rows of the given folders; none for no folder."""
    paths = [f"{root}/{folder}" for folder in sorted(set(folders))]
    if not paths:
        return spark.createDataFrame([], schema)
    return read_table(spark, paths, schema)


def leaf_folders(spark: SparkSession, root: str, folder: str, levels: int) -> dict[tuple, str]:
    """The partition folders of a table written under ``folder``: values, as text or None, to
    folder. They are read off the paths, without a job."""
    pattern, files = hadoop(spark, f"{root}/{folder}" + "/*=*" * levels)
    found = {}
    for status in files.globStatus(pattern) or []:
        names = status.getPath().toString().split("/")[-levels:]
        values = [name.partition("=")[2] for name in names]
        key = tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values)
        # glob patterns and readers take the name as it is on disk
        found[key] = "/".join([folder, *names])
    return found


def file_states(spark: SparkSession, path: str) -> list[list]:
    """(name, length, time of change) of the data files under ``path``, sorted; none if there is
    no such path."""
    folder, files = hadoop(spark, path)
    if not files.exists(folder):
        return []
    start = len(files.makeQualified(folder).toString())
    found, listed = [], files.listFiles(folder, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString()[start:]
        if not re.search(r"(^|/)[_.]", name):
            found.append([name, status.getLen(), status.getModificationTime()])
    return sorted(found)


def expire(spark: SparkSession, root: str, tables: Mapping[str, str], keep: int = 2) -> int:
    """Remove all but the last ``keep`` snapshots, and of ``tables`` (name to place) the folders
    that none of those names, what failed writers left behind included; how many folders went.

    Not to be run while a load or a reader of an older snapshot is at work.
    """
    numbers = _numbers(spark, root)
    last = numbers[-max(1, keep) :]
    named: set[str] = set()
    for number in last:
        snapshot = _load(spark, root, number)
        named |= snapshot.folders() | set(_texts(snapshot.notes))
    for number in numbers[: len(numbers) - len(last)]:
        path, files = hadoop(spark, f"{root}/{FOLDER}/{number:012d}.json")
        files.delete(path, False)
    # the second level is what one writer made; parts lie in it
    used = {"/".join(name.split("/")[:2]) for name in named}
    gone = 0
    for table, place in tables.items():
        folder, files = hadoop(spark, place)
        if not files.exists(folder):
            continue
        for status in files.listStatus(folder):
            if f"{table}/{status.getPath().getName()}" not in used:
                files.delete(status.getPath(), True)
                gone += 1
    return gone


def _texts(value) -> Iterable[str]:
    if isinstance(value, str):
        yield value
    elif isinstance(value, Mapping):
        for item in value.values():
            yield from _texts(item)
    elif isinstance(value, list):
        for item in value:
            yield from _texts(item)
