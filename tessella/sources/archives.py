"""Image archives: zip files that hold one image each, decoded in Arrow batches."""

import io
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.files import read_binary

Decoder = Callable[[bytes], np.ndarray]

RASTER_SCHEMA = (
    "file_name string, name string, height int, width int, channels int, pixels binary, error string, reason string"
)


def decode_npy(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def decode_tiff(data: bytes) -> np.ndarray:
    """Needs the ``tifffile`` package on the executors."""
    import tifffile

    return tifffile.imread(io.BytesIO(data))


class Rejected(ValueError):
    """An archive that cannot be used: one of the reasons below, and what exactly was wrong."""

    NOT_A_ZIP = "not a zip archive"
    NO_MEMBER = "no member with the suffix"
    UNDECODED = "does not decode"
    WRONG_KIND = "not uint8 rows x columns x channels"
    FEW_CHANNELS = "too few channels"
    WRONG_SIZE = "does not fit the tiles or blocks"

    def __init__(self, reason: str, detail: str = ""):
        super().__init__(detail)
        self.reason, self.detail = reason, detail


def open_image(archive: bytes | BinaryIO, suffix: str, decode: Decoder) -> np.ndarray | None:
    """Image of an archive, None when no member ends in ``suffix``; the last such wins.

    The archive may be an open file: then only its directory and the member are read.  A
    decoder that is not installed raises ImportError, anything else wrong :class:`Rejected`.
    """
    try:
        with zipfile.ZipFile(io.BytesIO(archive) if isinstance(archive, bytes) else archive) as zf:
            names = [n for n in zf.namelist() if n.endswith(suffix)]
            data = zf.read(names[-1]) if names else None
    except Exception as exc:  # whatever a damaged file makes of its reader
        raise Rejected(Rejected.NOT_A_ZIP, f"{type(exc).__name__}: {exc}") from exc
    if data is None:
        return None
    try:
        image = decode(data)
    except ImportError:
        raise
    except Exception as exc:
        raise Rejected(Rejected.UNDECODED, f"{type(exc).__name__}: {exc}") from exc
    if image.dtype != np.uint8 or image.ndim != 3:
        raise Rejected(Rejected.WRONG_KIND, f"expected uint8 rows x columns x channels, got {image.dtype} {image.shape}")
    return image


def iter_images(
    batch: pa.RecordBatch, suffix: str, decode: Decoder
) -> Iterator[tuple[str, np.ndarray | None, Rejected | None]]:
    """``(file_name, image, why)`` per archive of a batch with columns file_name, content.

    Bad archives are reported in their row; a missing decoder fails the job.
    """
    names, contents = batch.column("file_name"), batch.column("content")
    for i in range(batch.num_rows):
        try:
            yield names[i].as_py(), open_image(contents[i].as_py() or b"", suffix, decode), None
        except Rejected as why:
            yield names[i].as_py(), None, why


def archive_bytes(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """``file_name, content`` of the archives of a folder."""
    return read_binary(spark, folder, pattern).select("file_name", "content")


def read_rasters(
    archives: DataFrame, decode: Decoder = decode_tiff, suffix: str = ".tif"
) -> DataFrame:
    """Decode archives (``file_name, content``) to rasters, one row per archive.

    ``name`` is NULL for an archive without an image or with one that does not decode; ``reason``
    says which, and for the latter ``error`` what was wrong.  Pixels are uint8 in C order.  A
    decoder that is not installed fails the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_name, image, why in iter_images(batch, suffix, decode):
                if image is None:
                    reason = why.reason if why else Rejected.NO_MEMBER
                    row = [file_name, None, None, None, None, None, why and why.detail, reason]
                else:
                    row = [file_name, file_name, *image.shape, np.ascontiguousarray(image).tobytes(), None, None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], type=t) for v, t in zip(row, types)], names
                )

    names = ["file_name", "name", "height", "width", "channels", "pixels", "error", "reason"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()]
    return archives.select("file_name", "content").mapInArrow(run, RASTER_SCHEMA)


def drop_undecoded(rasters: DataFrame) -> DataFrame:
    """Rasters that hold an image."""
    return rasters.where(F.col("name").isNotNull())


def undecoded(rasters: DataFrame) -> DataFrame:
    """``file_name, error, reason`` of the archives that :func:`drop_undecoded` leaves out."""
    return rasters.where(F.col("name").isNull()).select("file_name", "error", "reason")


def distinct_names(rasters: DataFrame) -> DataFrame:
    """``name`` of every raster, for a sanity listing."""
    return drop_undecoded(rasters).select("name").distinct()
