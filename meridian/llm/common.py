"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.sources import scratch

#: A word is a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends there, and a lost executor costs nothing. ``scratch.clean`` deletes it."""
    return scratch.written(df, label)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: str = "doc_id"):
    """True where crc32(doc_id as text) mod 5 is 0; a null doc_id counts as the empty text (and so is held out)."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5) == 0


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the offsets of each row (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch | pa.Table, column: str, most: int) -> Iterator[pa.RecordBatch | pa.Table]:
    """Cut a batch into runs of whole rows with about ``most`` bytes of text each (one row at least), so that work arrays stay small."""
    _, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start, n = 0, batch.num_rows
    while start < n:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
