"""Media columns: grey-scale PNG in a binary column, written and read with zlib and numpy, and a low-frequency cosine-transform hash.

A payload is stored as an image 64 samples wide. The reader walks the chunks, tests the checksum of each, inflates all IDAT data and undoes
the five row filters; it takes any non-interlaced PNG with 8-bit grey samples, whoever wrote it.

Defined results: a null text counts as the empty one; an empty text is one row of zeros; texts of any length are stored whole; rows with one
doc_id are separate rows; an empty table gives an empty result. A media value that is null gives null features; one that is damaged raises
``ValueError`` under ``decode_png`` and gives ``error`` (and nulls) in the column operator. New columns replace those of their name.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, slices

WIDTH = 64
#: Fixed values of the PNG format: signature, and grey colour type with 8-bit samples.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GREY, DEPTH = 0, 8
#: Bytes of texts or media that are worked on at a time.
SLICE = 1 << 20
#: IDAT data are cut into chunks of this size.
IDAT_BYTES = 1 << 20
#: Side of the reduced image, and of the block of low frequencies that makes the hash.
SIDE, LOW = 32, 8


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode_png(payload: bytes, width: int = WIDTH, level: int = 3) -> bytes:
    """``payload`` (a positive multiple of ``width``) as a PNG; of the filters none, left and up the one with the smallest differences."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, width)
    left, up = image.copy(), image.copy()
    left[:, 1:] -= image[:, :-1]
    up[1:] -= image[:-1]
    cost = [int(np.abs(x.view(np.int8).astype(np.int16)).sum(dtype=np.int64)) for x in (image, left, up)]
    kind = int(np.argmin(cost))
    rows = np.empty((len(image), width + 1), np.uint8)
    rows[:, 0] = kind
    rows[:, 1:] = (image, left, up)[kind]
    data = zlib.compress(rows.tobytes(), level)
    header = struct.pack(">IIBBBBB", width, len(image), DEPTH, GREY, 0, 0, 0)
    body = b"".join(_chunk(b"IDAT", data[i : i + IDAT_BYTES]) for i in range(0, len(data), IDAT_BYTES))
    return SIGNATURE + _chunk(b"IHDR", header) + body + _chunk(b"IEND", b"")


def _unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo row filters, a run of equal filters at a time: 1 and 2 are running sums; 3 and 4 need the samples to their left one by one."""
    out = np.empty_like(rows)
    above = np.zeros(rows.shape[1], np.uint8)
    edges = np.flatnonzero(np.diff(kinds)) + 1
    for start, stop in zip([0, *edges], [*edges, len(rows)], strict=True):
        block, kind = rows[start:stop], kinds[start]
        if kind == 0:
            out[start:stop] = block
        elif kind == 1:
            np.cumsum(block, axis=1, dtype=np.uint8, out=out[start:stop])
        elif kind == 2:
            np.cumsum(block, axis=0, dtype=np.uint8, out=out[start:stop])
            out[start:stop] += above
        elif kind in (3, 4):
            for r in range(start, stop):
                line, up = rows[r].tolist(), (out[r - 1] if r else above).tolist()
                a = c = 0
                for x, b in enumerate(up):
                    if kind == 3:
                        guess = (a + b) >> 1
                    else:
                        pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                        guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
                    a, c = (line[x] + guess) & 255, b
                    line[x] = a
                out[r] = line
        else:
            raise ValueError(f"unknown row filter {kind}")
        above = out[stop - 1]
    return out


def decode_png(media: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG; ``ValueError`` if a chunk is cut short, fails its checksum or is missing."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, header, data, ended = 8, None, [], False
    while not ended:
        if at + 12 > len(media):
            raise ValueError("cut short")
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if len(body) < size or at + 12 + size > len(media):
            raise ValueError("cut short")
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if header is None or header[2:] != (DEPTH, GREY, 0, 0, 0):
        raise ValueError("only 8-bit grey images without interlacing")
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    except zlib.error as e:
        raise ValueError(f"image data: {e}") from e
    if len(raw) != header[1] * (header[0] + 1):
        raise ValueError("size of the image data")
    rows = raw.reshape(header[1], header[0] + 1)
    return _unfilter(rows[:, 0], rows[:, 1:])


@cache
def _cosines(size: int) -> np.ndarray:
    k, x = np.arange(LOW)[:, None], np.arange(size)[None, :]
    return np.cos(np.pi * (2 * x + 1) * k / (2 * size))


def _reduced(lines: np.ndarray) -> np.ndarray:
    """SIDE means of consecutive lines, or lines repeated if there are fewer."""
    n = len(lines)
    edges = np.arange(SIDE) * n // SIDE
    if n < SIDE:
        return lines[edges].astype(np.float64)
    return np.add.reduceat(lines, edges, axis=0, dtype=np.float64) / np.diff([*edges, n])[:, None]


def cosine_hash(image: np.ndarray) -> bytes:
    """64 bits: which of the LOW x LOW lowest cosine coefficients of the reduced image are above their median (the mean itself left out of it)."""
    small = _reduced(np.ascontiguousarray(_reduced(image).T)).T
    low = (_cosines(SIDE) @ small @ _cosines(SIDE).T).ravel()
    # Rounded, so that a coefficient which is zero but for rounding errors doesn't decide a bit.
    low = np.round(low, 6)
    return np.packbits(low > np.median(low[1:])).tobytes()


def padded(text: str | None, unit: int = WIDTH) -> bytes:
    raw = (text or "").encode("utf-8")
    return raw + b"\0" * (-len(raw) % unit if raw else unit)


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, cosine_hash binary, error string"


def _read(media: bytes | None) -> tuple:
    if media is None:
        return None, None, None, None, None
    try:
        image = decode_png(media)
    except ValueError as e:
        return None, None, None, None, str(e)
    raw = image.tobytes()
    return len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-WIDTH:]), cosine_hash(image), None


def _store(batches: Iterator[pa.RecordBatch], text: str, into: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text, SLICE):
            media = [encode_png(padded(t.as_py())) for t in part.column(text)]
            yield pa.record_batch([*part.columns, pa.array(media, pa.binary())], [*part.schema.names, into])


def _features(batches: Iterator[pa.RecordBatch], media: str, into: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [pa.field(name, kinds[kind]) for name, kind in (x.split() for x in FEATURES.split(", "))]
    for batch in batches:
        for part in slices(batch, media, SLICE):
            found = zip(*[_read(m.as_py()) for m in part.column(media)], strict=True)
            read = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(found, fields, strict=True)], fields=fields)
            yield pa.record_batch([*part.columns, read], [*part.schema.names, into])


def _schema(df: DataFrame, more: str) -> str:
    return "".join(f"`{c}` {kind}, " for c, kind in df.dtypes) + more


def with_media(df: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """``df`` with the text stored as a PNG in the binary column ``into``."""
    rows = df.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`") for c in df.columns if c != into])
    return rows.mapInArrow(lambda it: _store(it, "__text", into), _schema(rows, f"`{into}` binary")).drop("__text")


def with_features(df: DataFrame, media: str = "media", into: str = "read") -> DataFrame:
    """``df`` with a struct of what is read back from a PNG column: payload_bytes, payload_sha256, tail_crc32, cosine_hash (binary), error."""
    rows = df.select(F.col(f"`{media}`").alias("__media"), *[F.col(f"`{c}`") for c in df.columns if c != into])
    return rows.mapInArrow(lambda it: _features(it, "__media", into), _schema(rows, f"`{into}` struct<{FEATURES}>")).drop("__media")


def stored_and_read(df: DataFrame, text: str = "text", media: str = "media", into: str = "read") -> DataFrame:
    """What ``with_features(with_media(df))`` gives, in one pass: the worker that stored a slice reads it back, so no media wait."""
    rows = df.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`") for c in df.columns if c not in (media, into)])
    schema = _schema(rows, f"`{media}` binary, `{into}` struct<{FEATURES}>")
    return rows.mapInArrow(lambda it: _features(_store(it, "__text", media), media, into), schema).drop("__text")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes"))
    return stored_and_read(docs).select(
        "doc_id", "n_bytes", "read.payload_bytes", "read.payload_sha256", "read.tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), F.lower(F.hex("read.cosine_hash")).alias("feature"),
    )


QUERIES = {"op5_media": op5_media}
ORACLE: dict[str, str] = {}
