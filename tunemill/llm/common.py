"""What the operators of this package share: stored tables, words of a text, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.session import scratch_path
from tunemill.sources.tables import file_system_path

#: A text cut at this pattern gives the words of the `[^\x20\x09-\x0D]+` operators.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that a task works on at a time. One longer text is a slice of its own.
SLICE_BYTES = 8_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_ALNUM = bytes(
    byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else byte + 32 if 0x41 <= byte <= 0x5A else 0x20
    for byte in range(256)
)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back; a lost executor costs no recomputation."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `stored` gave, once all that is made of them is written itself."""
    for table in tables:
        files, path = file_system_path(table.sparkSession, table.stored_path)
        files.delete(path, True)


def encoded(text: str | None) -> bytes:
    """UTF-8; a null is empty, and half a surrogate pair keeps its three bytes."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters, digits and everything beyond ASCII.

    All bytes of a character beyond ASCII are 0x80 or more, so the cut can be made on bytes.
    """
    return text.translate(_ALNUM).split()


def space_words(text: bytes) -> list[bytes]:
    """Runs without ASCII white space: bytes.split cuts at 0x20 and 0x09-0x0D, nothing else."""
    return text.split()


def in_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut to about `limit` bytes of text each, so that memory doesn't follow the batch size."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def per_row(
    df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text"
) -> DataFrame:
    """`rows` applied to slices of the table, inside the tasks that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, text):
            yield rows(part)

    return df.mapInArrow(run, schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """One row of five by the CRC-32 of the id as text; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
