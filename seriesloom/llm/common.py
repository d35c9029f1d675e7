"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.session import scratch_path

#: SQL that lower-cases A-Z only.
ASCII_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Returns freed memory to the system; a Python worker lives on for later tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(function: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()
    return run


def map_arrow(frame: DataFrame, function: Callable, schema: str) -> DataFrame:
    ship(frame.sparkSession)
    return frame.mapInArrow(tidy(function), schema)


def map_pandas(frame: DataFrame, function: Callable, schema) -> DataFrame:
    ship(frame.sparkSession)
    return frame.mapInPandas(function, schema)


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns an operator reads, so that other columns never clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(doc_id: Column | str, modulo: int) -> Column:
    """crc32 of the id as text, modulo ``modulo``; a null id falls in no fold (-1)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulo)), F.lit(-1))


def written_at(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The frame as a table in the shared folder, and where it lies."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder; later steps read files, not their lineage."""
    return written_at(frame, label)[0]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null reads as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text",
                  most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of text; one row is never divided."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def arrow(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns.values()], list(columns))
