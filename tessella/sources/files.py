"""Text and binary files of a folder.

Spark's own readers leave out names that start with ``_`` or ``.`` and, for whole files, empty
ones.  Each reader here adds those, read in Python (:mod:`tessella.sources.planned`), so that every
regular file of a folder counts.
"""

import fnmatch
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from tessella.functions.markup import split_on
from tessella.sources.planned import File, FilePart, deal, filesystem, list_folder, partition_bytes

_FILE = pa.schema([("file_name", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])


class ListedFiles(DataSource):
    """Whole files by a list of paths and sizes, one row each.  Options ``folder``, ``files``, ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "listed_files"

    def schema(self) -> str:
        return "file_name string, path string, length long, content binary"

    def reader(self, schema) -> "ListedReader":
        return ListedReader(dict(self.options))


class ListedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["folder"]
        lines = [line.rsplit("\t", 1) for line in options["files"].split("\n") if line]
        self.files = [File(path, path.rsplit("/", 1)[-1], int(size)) for path, size in lines]
        self.most = int(options["partition_bytes"])

    def partitions(self) -> Sequence[FilePart]:
        return deal(self.files, self.most)

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.folder)
        for file in partition.files:
            with store.open_input_stream(file.path) as opened:
                content = opened.read()
            row = {"file_name": file.name, "path": file.path, "length": len(content), "content": content}
            yield pa.RecordBatch.from_pylist([row], _FILE)


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _listed(path: str, pattern: str) -> list[File]:
    """The files a path names: those of a folder, a single file, or those a last part with wildcards matches."""
    parent, _, last = path.rstrip("/").rpartition("/")
    if any(c in last for c in "*?["):
        return list_folder(parent, last)
    store, inner = filesystem(path)
    info = store.get_file_info(inner)
    if info.type == pafs.FileType.File:
        return [f for f in [File(info.path, info.base_name, info.size)] if fnmatch.fnmatchcase(f.name, pattern)]
    return list_folder(path, pattern)


def unseen_files(spark: SparkSession, paths: str | list[str], pattern: str = "*", empty: bool = True) -> DataFrame | None:
    """``file_name, path, length, content`` of the files that Spark's readers leave out: hidden names and,
    with ``empty``, empty files.  None where there are none, or where the store is one that only
    Spark can open."""
    found: list[File] = []
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            listed = _listed(path, pattern)
        except (OSError, ValueError, pa.ArrowException):
            continue  # Spark opens it, or says why not
        found += [f for f in listed if _hidden(f.name) or empty and not f.size]
    if not found:
        return None
    spark.dataSource.register(ListedFiles)
    files = "\n".join(f"{f.path}\t{f.size}" for f in found)
    first = paths if isinstance(paths, str) else paths[0]
    reader = spark.read.format("listed_files").options(folder=first, files=files, partition_bytes=str(partition_bytes(spark)))
    return reader.load()


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file_name, length`` of the regular files of one folder, not recursive.

    No file is opened but those with hidden names: the content column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").load(folder).select(F.col("_metadata.file_name").alias("file_name"), "length")
    unseen = unseen_files(spark, folder)
    return files if unseen is None else files.unionByName(unseen.select("file_name", "length"))


def read_whole_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file_name, content``: one row per file, line ends kept.

    A file is one row, so this suits files of some megabytes.  For large ones use
    :func:`read_records`.
    """
    files = spark.read.text(paths, wholetext=True)
    rows = files.select(F.col("_metadata.file_name").alias("file_name"), F.make_valid_utf8("value").alias("content"))
    unseen = unseen_files(spark, paths)
    return rows if unseen is None else rows.unionByName(unseen.select("file_name", _text().alias("content")))


def _text():
    return F.make_valid_utf8(F.col("content").cast("string"))


def read_records(spark: SparkSession, paths: str | list[str], end: str) -> DataFrame:
    """``file_name, content``: one row per piece of a file that ends with the literal ``end``.

    Files are split across tasks at record ends, so one file may be as large as it likes; those
    with hidden names are read whole and then cut.
    """
    files = spark.read.text(paths, lineSep=end)
    rows = files.select(F.col("_metadata.file_name").alias("file_name"), F.make_valid_utf8("value").alias("content"))
    unseen = unseen_files(spark, paths, empty=False)
    if unseen is None:
        return rows
    pieces = unseen.select("file_name", F.explode(split_on(_text(), end)).alias("content"))
    return rows.unionByName(pieces.where("content <> ''"))


def read_binary(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``file_name, path, modificationTime, length, content``, one row per file; files that only Python
    sees have no modification time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    rows = files.select(F.col("_metadata.file_name").alias("file_name"), "path", "modificationTime", "length", "content")
    unseen = unseen_files(spark, folder, pattern)
    return rows if unseen is None else rows.unionByName(unseen, allowMissingColumns=True)
