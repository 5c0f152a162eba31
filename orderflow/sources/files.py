"""Which files of a folder can be read.

Release and cancellation lists are kept by hand, one or more files per campaign.  Every file is opened once, in
tasks, before the lists are read: one that is damaged is named with its error and set aside, and the files that can
be read are grouped by the columns and types they hold, so that lists with different types are read side by side.
"""

from __future__ import annotations

import bz2
import gzip
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Larger files are not opened beforehand (a list kept by hand is far smaller); a task holds one file at a time.
CHECKED_BYTES = 256 << 20
STATES = "path string, length long, error string, signature string"
_UNPACK = {".gz": gzip.decompress, ".bz2": bz2.decompress}


def _parquet(content: bytes) -> pa.Schema:
    from pyarrow import parquet
    return parquet.read_table(io.BytesIO(content)).schema


def _orc(content: bytes) -> pa.Schema:
    from pyarrow import orc
    return orc.ORCFile(io.BytesIO(content)).read().schema


def _opener(fmt: str, encoding: str) -> Callable[[str, bytes], str]:
    """Reads a whole file, or raises; gives the columns and types that it names itself."""

    def binary(path: str, content: bytes) -> str:
        schema = (_parquet if fmt == "parquet" else _orc)(content)
        return ", ".join(sorted(f"{f.name} {f.type}" for f in schema))

    def text(path: str, content: bytes) -> str:
        unpack = next((u for end, u in _UNPACK.items() if path.endswith(end)), None)
        (unpack(content) if unpack else content).decode(encoding)
        return ""

    return binary if fmt in ("parquet", "orc") else text


def file_states(spark: SparkSession, folder: str, fmt: str, options: dict[str, str] | None = None) -> DataFrame | None:
    """(path, length, error, signature) of every file of a folder, error null where the file can be read; None without
    a folder."""
    lower = {k.lower(): v for k, v in (options or {}).items()}
    open_file = _opener(fmt, lower.get("encoding", lower.get("charset", "utf-8")))
    try:
        files = spark.read.format("binaryFile").load(folder)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for path, length, content in zip(*(batch.column(k) for k in range(3))):
                try:
                    states.append((path.as_py(), length.as_py(), None, open_file(path.as_py(), content.as_py())))
                except Exception as error:  # whatever a damaged file raises is its state
                    states.append((path.as_py(), length.as_py(), f"{type(error).__name__}: {error}"[:500], None))
            yield pa.RecordBatch.from_pylist([dict(zip(("path", "length", "error", "signature"), s)) for s in states],
                                             pa.schema([("path", pa.string()), ("length", pa.int64()),
                                                        ("error", pa.string()), ("signature", pa.string())]))

    small = files.where(F.col("length") <= CHECKED_BYTES).select("path", "length", "content").mapInArrow(run, STATES)
    large = files.where(F.col("length") > CHECKED_BYTES).select("path", "length", F.lit(None).cast("string").alias("error"),
                                                                F.lit("").alias("signature"))
    return small.unionByName(large)


def literal_path(path: str) -> str:
    """The path with the signs that a reader would take for a pattern escaped."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)
