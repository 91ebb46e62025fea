"""Files listed and dealt to tasks by size, for data sources that read them in Python.

Listing sees every regular file of a folder, also names that start with ``_`` or ``.``, which
Spark's own readers leave out.  Paths are local or URIs of a store that pyarrow can open.
"""

import fnmatch
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import InputPartition

#: What opening a file counts for when files are dealt, as in Spark's own readers.
OPEN_COST = 4 << 20


@dataclass(frozen=True)
class File:
    path: str
    name: str
    size: int


@dataclass
class FilePart(InputPartition):
    """Files that one task reads."""

    files: tuple[File, ...]


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path)


def list_folder(folder: str, pattern: str = "*") -> list[File]:
    """The regular files of one folder whose names match, by name; not recursive."""
    store, path = filesystem(folder)
    found = store.get_file_info(pafs.FileSelector(path, recursive=False))
    files = [File(f.path, f.base_name, f.size) for f in found if f.type == pafs.FileType.File]
    return sorted((f for f in files if fnmatch.fnmatchcase(f.name, pattern)), key=lambda f: f.name)


def deal(files: list[File], most: int) -> list[FilePart]:
    """Files packed into parts of at most ``most`` bytes, opening costs included, largest first
    into the first part with room; a larger file is a part of its own."""
    parts: list[list[File]] = []
    room: list[int] = []
    for f in sorted(files, key=lambda f: (-f.size, f.name)):
        need = f.size + OPEN_COST
        # only the last parts can have room for much, so few are looked at
        at = next((i for i in range(max(0, len(parts) - 64), len(parts)) if room[i] >= need), None)
        if at is None:
            parts.append([f])
            room.append(most - need)
        else:
            parts[at].append(f)
            room[at] -= need
    return [FilePart(tuple(p)) for p in parts]


def partition_bytes(spark: SparkSession) -> int:
    """The session's ``spark.sql.files.maxPartitionBytes``."""
    digits = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(digits[-1:], 1)
    return int(digits.rstrip("kmg")) * scale
