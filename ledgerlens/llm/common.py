"""What several operators share: words, text columns and files in the shared folder."""

from __future__ import annotations

import hashlib
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A word is a run of bytes outside these: space and the control characters 9 to 13. They are the
# white space that bytes.split() knows.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def utf8(text: Column) -> Column:
    """The text's bytes; null text is empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def lower_words(text: bytes) -> list[bytes]:
    """Words with A-Z lowered; other letters stay as they are."""
    return text.lower().split()


def mix64(h: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers, after which every bit depends on all."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL text; only on the driver."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def slices(rows: pa.RecordBatch, column: str, most: int):
    """The rows in runs of about ``most`` bytes of a binary column, one row at least."""
    sizes = pc.cumulative_sum(pc.fill_null(pc.cast(pc.binary_length(rows.column(column)), pa.int64()), 0)).to_pylist()
    start, base = 0, 0
    for i, upto in enumerate(sizes):
        if upto - base >= most or i == len(sizes) - 1:
            yield rows.slice(start, i + 1 - start)
            start, base = i + 1, upto


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_once(uri: str, data: bytes) -> str:
    """Writes under a temporary name and renames: readers see the whole file or none.

    Two attempts of a task write the same bytes, so whichever renames last changes nothing.
    Returns the SHA-256 of the content.
    """
    fs, path = _file_system(uri)
    folder, name = os.path.split(path)
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(data)
    fs.move(temporary, path)
    return hashlib.sha256(data).hexdigest()


def mapped(uri: str) -> pa.Buffer:
    """A file's content: memory-mapped where the shared folder is a file system, else read."""
    fs, path = _file_system(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with fs.open_input_file(path) as source:
        return source.read_buffer()


def files(df_or_spark, folder: str, pattern: str) -> DataFrame:
    """``name`` and ``content`` of the files of a folder."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
