"""Folders of zipped rasters as a data source: planned partitions, features, and reject rows.

An archive is opened where it lies, so only its directory and its image are read, and it may be
larger than a row can be.  Files are dealt to tasks by size.
"""

import importlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from tessella.operators.tiles import SCAN_SCHEMA, scan_batch
from tessella.sources import archives
from tessella.sources.archives import Decoder, Rejected
from tessella.sources.planned import FilePart, deal, filesystem, list_folder, partition_bytes

#: Decoders by short name: the function, and the package it needs on every node.
DECODERS = {"tiff": (archives.decode_tiff, "tifffile"), "npy": (archives.decode_npy, "numpy")}


def find_decoder(name: str) -> Decoder:
    """A decoder by short name or as ``module:function``.  Raises ImportError where it, or what it
    needs, is not installed, on the driver before any task starts."""
    if name in DECODERS:
        decode, needs = DECODERS[name]
        importlib.import_module(needs)
        return decode
    module, _, function = name.partition(":")
    try:
        return getattr(importlib.import_module(module), function)
    except AttributeError as missing:
        raise ImportError(f"no decoder {name!r}") from missing


class ZippedRasters(DataSource):
    """Options: ``path``, ``pattern``, ``suffix``, ``decoder``, ``tile`` (empty for the rule by side length),
    ``blocks`` (comma list), ``compat_index``, ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "zipped_rasters"

    def schema(self) -> str:
        return SCAN_SCHEMA

    def reader(self, schema) -> "RasterReader":
        return RasterReader(dict(self.options))


class RasterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*.zip")
        self.suffix = options.get("suffix", ".tif")
        self.decoder = options.get("decoder", "tiff")
        self.tile = int(options["tile"]) if options.get("tile") else None
        self.blocks = [int(b) for b in options.get("blocks", "10").split(",")]
        self.compat_index = options.get("compat_index", "false") == "true"
        self.most = int(options["partition_bytes"])
        find_decoder(self.decoder)

    def partitions(self) -> Sequence[FilePart]:
        return deal(list_folder(self.folder, self.pattern), self.most) or [FilePart(())]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        decode = find_decoder(self.decoder)
        store, _ = filesystem(self.folder)
        for file in partition.files:
            image = why = None
            with store.open_input_file(file.path) as opened:
                try:
                    image = archives.open_image(opened, self.suffix, decode)
                except Rejected as bad:
                    why = bad
            yield scan_batch(file.name, image, why, self.blocks, self.tile, self.compat_index)


def scan_folder(
    spark: SparkSession, folder: str, blocks: Sequence[int] = (10,), tile: int | None = 500, decoder: str = "tiff",
    suffix: str = ".tif", pattern: str = "*.zip", compat_index: bool = False,
) -> DataFrame:
    """What :func:`tessella.operators.tiles.scan_archives` gives, read through the data source."""
    spark.dataSource.register(ZippedRasters)
    reader = spark.read.format("zipped_rasters").options(
        pattern=pattern, suffix=suffix, decoder=decoder, tile=str(tile or ""), blocks=",".join(map(str, blocks)),
        compat_index=str(compat_index).lower(), partition_bytes=str(partition_bytes(spark)),
    )
    return reader.load(folder)
