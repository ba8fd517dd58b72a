"""Documents in batches, and hashes over runs of their bytes and words.

A batch is a group of some hundred documents, chosen by a hash of the row and sorted, so that it is the same in every attempt. Operators that
match passages send one packed message from each batch to each hash bucket instead of a row for each position: a value that occurs in a
batch a thousand times is sent once, so a hot passage costs a bucket one entry for each batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import shuffle_partitions, text_bytes

#: Multipliers of the rolling hashes (odd, so that they can be undone modulo 2**64), for two independent hashes.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: A null doc_id comes after all others.
LAST = np.iinfo(np.int64).max
_CHUNK = 1 << 17
_tables: dict[tuple[int, bool], np.ndarray] = {}


def powers(multiplier: int, n: int, inverse: bool = False) -> np.ndarray:
    """multiplier**0 .. multiplier**(n - 1) modulo 2**64, or those of its inverse."""
    table = _tables.get((multiplier, inverse))
    if table is None or len(table) < n:
        base = pow(multiplier, -1, 1 << 64) if inverse else multiplier
        table = np.full(max(n, _CHUNK + 64), base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if len(table) <= 4 * _CHUNK:
            _tables[multiplier, inverse] = table
    return table[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (a finaliser of two multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, multiplier: int) -> np.ndarray:
    """Hash of values[s:e] for each span; spans are sorted by start. Worked on in runs, so that the tables of powers stay small."""
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        lo = int(starts[k])
        stop = max(k + 1, int(np.searchsorted(starts, lo + _CHUNK)))
        stop = max(k + 1, min(stop, k + int(np.searchsorted(ends[k:stop], lo + _CHUNK, "right"))))
        hi = int(ends[k:stop].max())
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((values[lo:hi].astype(np.uint64) + np.uint64(1)) * powers(multiplier, hi - lo), out=sums[1:])
        s, e = starts[k:stop] - lo, ends[k:stop] - lo
        found = (sums[e] - sums[s]) * powers(multiplier, hi - lo + 1, inverse=True)[s]
        out[k:stop] = mixed(found ^ ((e - s).astype(np.uint64) << np.uint64(48)))
        k = stop
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes, and the row that each belongs to; ``at``: offsets of the rows."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def rolling_hashes(values: np.ndarray, n: int, multiplier: int) -> np.ndarray:
    """Hash of each run of n values, equal to ``span_hashes`` of it; the caller leaves out runs that cross documents."""
    out = np.empty(max(0, len(values) - n + 1), np.uint64)
    for lo in range(0, len(out), _CHUNK):
        hi = min(lo + _CHUNK, len(out))
        part = values[lo : hi + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(multiplier, len(part)), out=sums[1:])
        found = sums[n:] - sums[:-n]
        found *= powers(multiplier, len(found), inverse=True)
        out[lo:hi] = mixed(found ^ np.uint64(n << 48))
    return out


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each word, the halves of its XXH3 of 128 bits."""
    data, digest = raw.tobytes(), xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def same_spans(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether raw[a : a + size] and raw[b : b + size] are the same bytes, for each of some spans of at least one byte."""
    out = np.empty(len(a), bool)
    ends = np.cumsum(size)
    k = 0
    while k < len(a):
        stop = max(k + 1, int(np.searchsorted(ends, ends[k] - size[k] + _CHUNK, "right")))
        n = size[k:stop]
        begin = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(begin, n)
        out[k:stop] = np.logical_and.reduceat(raw[np.repeat(a[k:stop], n) + step] == raw[np.repeat(b[k:stop], n) + step], begin)
        k = stop
    return out


def in_batches(df: DataFrame, bytes_each: int = 1 << 20, text: str = "text") -> tuple[DataFrame, int]:
    """``df`` with ``__batch``; so many that one holds about ``bytes_each`` of text, whatever the size of the table. And the bytes of all texts."""
    total = int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)
    n = max(shuffle_partitions(df.sparkSession), -(-total // bytes_each))
    return df.withColumn("__batch", F.pmod(F.xxhash64("doc_id", text, F.lit(17)), F.lit(int(n)))), total


def ordered(table: pa.Table) -> pa.Table:
    """The rows of a batch in an order that doesn't depend on how they came: by doc_id, then text."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])).combine_chunks() if table.num_rows else table


class Batch:
    """Bytes, words and ids of the documents of one batch."""

    def __init__(self, table: pa.Table):
        self.table = ordered(table)
        self.raw, self.at = text_bytes(self.table.column("text"))
        ids = self.table.column("doc_id")
        self.ids = (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.starts, self.ends, self.row = word_spans(self.raw, self.at)
        #: Place of the first word of each row.
        self.first = np.searchsorted(self.row, np.arange(len(self.ids) + 1))
        return self.starts, self.ends, self.row


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0 .. n - 1 by the upper half of the hash: ascending hashes have ascending buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def cuts(sorted_buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each run of equal values."""
    edges = np.flatnonzero(np.diff(sorted_buckets)) + 1
    return np.concatenate([[0], edges]).astype(np.int64) if len(sorted_buckets) else np.zeros(0, np.int64), np.append(edges, len(sorted_buckets)) if len(sorted_buckets) else np.zeros(0, np.int64)


def narrow(ids: np.ndarray) -> bytes:
    """Ids as a base and offsets of four bytes, or eight where they lie further apart."""
    base = int(ids.min())
    wide = int(ids.max()) - base >= 1 << 32
    return np.int64(base).tobytes() + (ids if wide else (ids - base).astype(np.uint32)).tobytes()


def widen(data: bytes, n: int) -> np.ndarray:
    base = np.frombuffer(data, np.int64, 1)[0]
    if len(data) == 8 + 8 * n:
        return np.frombuffer(data, np.int64, n, 8)
    return np.frombuffer(data, np.uint32, n, 8).astype(np.int64) + base


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places are covered by a window of ``length`` that begins at one of ``starts``."""
    steps = np.zeros(n + length + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:n]) > 0


def packed_table(rows: list[tuple], schema: str) -> pa.Table:
    """Messages as a table with the columns of a schema of long, int and binary."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [name for name, _ in fields])
