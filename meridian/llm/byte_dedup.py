"""Suffix-array dedup of repeated byte strings across documents.

The bytes covered by a string of ``length`` (50) bytes that also starts in a document with a smaller doc_id are removed. Suffix arrays of
one machine's size are made for shards, so equal strings have to meet in one shard:

1. anchors: the anchor of a window of 50 bytes is the 20-byte run in it with the least hash. Equal windows have equal anchors, and a run of
   neighbouring windows has the same one. Each batch of documents sends the hashes of its anchors to buckets, which answer those that occur
   in a second document; windows of the others can't be repeated;
2. shards: a run of windows with one live anchor is cut out as a piece (up to 80 bytes) and sent to the shard of its anchor. A shard puts
   its distinct pieces into one string, makes the suffix array by induced sorting and the permuted common prefixes, and so finds all groups
   of equal windows and the smallest doc_id of each;
3. removal: the shard answers each batch which windows go.

Equal pieces of a batch are sent once, with the places of all that the smallest of its documents has. An anchor with more than ``hot_bytes`` of pieces (a common line between texts that differ) would
overload its shard; each of its windows goes as a piece of its own, to the shard of its own hash. Hashes only bring pieces together: pieces
count as equal when their bytes do.

Defined results: a null text is empty; a null doc_id comes after all others; rows with one doc_id are one document for the comparison and
stay separate rows; an empty table gives an empty result; texts are taken whole; ``keep`` names further columns to carry. What is kept need
not be valid UTF-8 and so is binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.batches import MULTIPLIERS, Batch, buckets_of, cuts, in_batches, mixed, narrow, packed_table, rolling_hashes, same_spans, span_hashes, widen
from meridian.llm.common import documents, shuffle_partitions
from meridian.llm.suffix_array import permuted_lcp, suffix_array

#: Bytes of an anchor.
ANCHOR = 20
#: Shards of text whose anchors and pieces meet in one bucket, where they are worked on shard by shard.
BUCKET = 16
#: A byte that UTF-8 never has, between the pieces of a shard.
BETWEEN = 0xFF
ANCHORS = "__bucket long, __batch long, n int, hashes binary, shared binary, pieces binary"
LIVE = "__batch long, __bucket long, n int, live binary"
PIECES = "__bucket long, __batch long, n int, parts binary, widths binary, bytes binary, ids binary, counts binary, places binary"
GONE = "__batch long, places binary, windows binary"
#: New columns; one of these names that is to be kept is left out.
COUNTS = ("n_bytes", "n_removed", "n_spans", "kept")


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if width > span else out


class _Anchored:
    """Runs of windows of a batch that have one anchor, and the distinct anchors by ascending hash."""

    def __init__(self, batch: Batch, length: int):
        raw, at, span, self.length = batch.raw, batch.at, length - ANCHOR + 1, length
        self.first = self.last = self.anchor = np.zeros(0, np.int64)
        if len(raw) >= length:
            hashes = rolling_hashes(raw, ANCHOR, MULTIPLIERS[0])
            # The place breaks ties, so that the leftmost of equal runs is the anchor.
            best = _least((hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64), span)
            anchor = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
            inside = np.zeros(len(anchor) + 1, np.int32)  # windows that don't cross documents
            begin, end = at[:-1], np.maximum(at[1:] - length + 1, at[:-1])
            np.add.at(inside, np.minimum(begin, len(anchor)), 1)
            np.add.at(inside, np.minimum(end, len(anchor)), -1)
            good = np.cumsum(inside[:-1]) > 0
            change = np.ones(len(anchor), bool)
            change[1:] = (anchor[1:] != anchor[:-1]) | (good[1:] != good[:-1])
            start = np.flatnonzero(change)
            stop = np.append(start[1:], len(anchor))
            keep = good[start]
            self.first, self.last = start[keep], stop[keep] - 1
            self.anchor = anchor[self.first]
        # Mixed again: anchors have the least hashes of their windows, and buckets by these would be uneven.
        self.hash = mixed(hashes[self.anchor] + np.uint64(1)) if len(self.anchor) else np.zeros(0, np.uint64)
        self.row = np.searchsorted(at, self.first, "right") - 1
        self.order = np.argsort(self.hash, kind="stable")
        self.start, self.stop = cuts(self.hash[self.order])
        self.distinct = self.hash[self.order][self.start]

    def messages(self, batch: Batch, key: int, n_buckets: int) -> list[tuple]:
        ids = batch.ids[self.row[self.order]]  # rows are sorted by id
        shared = ids[self.start] != ids[self.stop - 1]
        pieces = self._pieces(batch.raw, shared)
        at = np.append(0, np.cumsum(shared))
        buckets, low = buckets_of(self.distinct, n_buckets), self.distinct.astype(np.uint32)
        return [
            (int(buckets[a]), key, int(b - a), low[a:b].tobytes(), np.packbits(shared[a:b]).tobytes(), pieces[at[a] : at[b]].tobytes())
            for a, b in zip(*cuts(buckets), strict=True)
        ]

    def _pieces(self, raw: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """How many different pieces the anchors in two documents have here (255 at most), by the first and last 32 bytes of the pieces."""
        size = (self.stop - self.start)[shared]
        if not len(size):
            return np.zeros(0, np.uint8)
        run = self.order[np.repeat(shared, self.stop - self.start)]
        eight = np.lib.stride_tricks.sliding_window_view(raw, 8)
        left, right = self.first[run], self.last[run] + self.length - 8
        sign = (right - left).astype(np.uint64)
        for at in (*(left + k for k in range(0, 32, 8)), *(right - k for k in range(0, 32, 8))):
            sign = mixed((sign + np.uint64(1)) ^ eight[at].view(np.uint64).ravel())
        of = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((sign, of))
        new = np.append(True, (np.diff(of[order]) > 0) | (sign[order][1:] != sign[order][:-1]))
        return np.minimum(np.bincount(of[order][new], minlength=len(size)), 255).astype(np.uint8)


def _anchors(key: tuple, table: pa.Table, length: int, n_buckets: int) -> pa.Table:
    batch = Batch(table)
    return packed_table(_Anchored(batch, length).messages(batch, key[0].as_py(), n_buckets), ANCHORS)


def _live(key: tuple, table: pa.Table, hot: int) -> pa.Table:
    """For each anchor sent to a bucket: 0 if only one document has it, else 1, or 2 if it has more than ``hot`` pieces."""
    sizes = table.column("n").to_pylist()
    hashes = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("hashes").to_pylist()])
    shared = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).view(bool) for x, n in zip(table.column("shared").to_pylist(), sizes, strict=True)])
    pieces = np.ones(len(hashes), np.int64)
    pieces[shared] = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("pieces").to_pylist()])
    order = np.argsort(hashes, kind="stable")
    start, stop = cuts(hashes[order])
    state = (np.logical_or.reduceat(shared[order], start) | (stop - start > 1)).astype(np.uint8)
    state[(state > 0) & (np.add.reduceat(pieces[order], start) > hot)] = 2
    out = np.empty(len(hashes), np.uint8)
    out[order] = np.repeat(state, stop - start)
    at = np.concatenate([[0], np.cumsum(sizes)])
    bits = lambda x: np.packbits(x > 0).tobytes() + (np.packbits(x > 1).tobytes() if (x > 1).any() else b"")
    rows = [(b, key[0].as_py(), n, bits(out[i : i + n])) for b, n, i in zip(table.column("__batch").to_pylist(), sizes, at[:-1], strict=True) if out[i : i + n].any()]
    return packed_table(rows, LIVE)


def _different(raw: np.ndarray, first: np.ndarray, size: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which of some pieces, sorted by ``keys``, differ from the one before; those with equal keys are compared."""
    new = np.ones(len(first), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in (size, *keys)])
    again = np.flatnonzero(~new)
    new[again] = ~same_spans(raw, first[again], first[again - 1], size[again])
    return new


def _pieces(key: tuple, table: pa.Table, hits: pa.Table, length: int, n_buckets: int) -> pa.Table:
    """Pieces with live anchors, sent to their shards; those repeated within the batch are settled here, and pass with a bucket below zero."""
    if not hits.num_rows:
        return packed_table([], PIECES)
    batch = Batch(table)
    runs = _Anchored(batch, length)
    buckets = buckets_of(runs.distinct, n_buckets)
    state = np.zeros(len(runs.distinct), np.uint8)
    for bucket, n, bits in zip(hits.column("__bucket").to_pylist(), hits.column("n").to_pylist(), hits.column("live").to_pylist(), strict=True):
        at, size = np.searchsorted(buckets, np.uint64(bucket)), -(-n // 8)
        for k in range(0, len(bits), size):
            state[at : at + n] += np.unpackbits(np.frombuffer(bits[k : k + size], np.uint8), count=n)
    of_run = np.empty(len(runs.order), np.uint8)
    of_run[runs.order] = np.repeat(state, runs.stop - runs.start)
    first, last, to = runs.first[of_run == 1], runs.last[of_run == 1], runs.hash[of_run == 1]
    if (of_run == 2).any():
        lone = np.concatenate([np.arange(a, b + 1) for a, b in zip(runs.first[of_run == 2], runs.last[of_run == 2], strict=True)])
        first, last = np.concatenate([first, lone]), np.concatenate([last, lone])
        order = np.argsort(first, kind="stable")
        first, last = first[order], last[order]
        to = np.concatenate([to, span_hashes(batch.raw, lone, lone + length, MULTIPLIERS[0])])[order]
    if not len(first):
        return packed_table([], PIECES)
    stop = last + length
    h = span_hashes(batch.raw, first, stop, MULTIPLIERS[1])
    ids = batch.ids[np.searchsorted(batch.at, first, "right") - 1]
    order = np.lexsort((first, h, to))  # the places of equal pieces ascend, and so do their ids
    first, last, stop, to, h, ids = (x[order] for x in (first, last, stop, to, h, ids))
    new = _different(batch.raw, first, stop - first, h, to)
    least = np.repeat(ids[new], np.diff(np.append(np.flatnonzero(new), len(ids))))
    here = ids > least
    rows = []
    if here.any():
        number, bits = key[0].as_py(), (np.uint64(2) << (last - first)[here].astype(np.uint64)) - np.uint64(1)
        rows = [(-1 - number % n_buckets, number, int(here.sum()), b"", b"", bits.astype(np.uint32).tobytes(), b"", b"", first[here].astype(np.uint32).tobytes())]
    # What is left of equal pieces is of one document: one goes for all.
    place, head = first[~here].astype(np.uint32), np.flatnonzero(new[~here])
    first, last, stop, to, ids = (x[~here][head] for x in (first, last, stop, to, ids))
    size, head = stop - first, np.append(head, len(place))
    at = np.concatenate([[0], np.cumsum(size)])
    data = batch.raw[np.arange(at[-1]) - np.repeat(at[:-1] - first, size)]
    buckets, part = buckets_of(to, n_buckets), to.astype(np.uint32)
    for a, b in zip(*cuts(buckets), strict=True):
        rows.append((
            int(buckets[a]), key[0].as_py(), int(b - a), part[a:b].tobytes(), (last - first)[a:b].astype(np.uint8).tobytes(), data[at[a] : at[b]].tobytes(),
            narrow(ids[a:b]), np.diff(head[a : b + 1]).astype(np.uint32).tobytes() if head[b] - head[a] > b - a else b"", place[head[a] : head[b]].tobytes(),
        ))
    return packed_table(rows, PIECES)


def _least_ids(pieces: np.ndarray, start: np.ndarray, width: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each window of each distinct piece, the smallest id of a piece that has it, in the order of the windows; by a suffix array.

    ``pieces``: the shard's string; ``start``: of each piece; ``width``: its windows; ``ids``: the smallest of its documents.
    """
    order = suffix_array(pieces)
    # Distinct pieces of up to 2 * length bytes: no common prefix is longer than two of them.
    lcp = permuted_lcp(pieces, order, 4 * length + 4)
    owner = np.full(len(pieces), -1, np.int32)
    at = np.cumsum(width) - width
    windows = np.arange(at[-1] + width[-1]) - np.repeat(at - start, width)
    owner[windows] = np.repeat(np.arange(len(start)), width)
    new = lcp[order] < length
    new[0] = True
    group = np.empty(len(pieces), np.int64)
    group[order] = np.cumsum(new) - 1
    best = np.where(owner[order] >= 0, ids[owner[order]], np.iinfo(np.int64).max)
    return np.minimum.reduceat(best, np.flatnonzero(new))[group[windows]]


def _shard(key: tuple, table: pa.Table, length: int, shard_bytes: int) -> pa.Table:
    if key[0].as_py() < 0:
        return table.select(["__batch", "places", "bytes"]).rename_columns(["__batch", "places", "windows"])
    n = table.column("n").to_pylist()
    column = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
    part, width, data, place = column("parts", np.uint32), column("widths", np.uint8).astype(np.int64) + 1, column("bytes", np.uint8), column("places", np.uint32)
    ids = np.concatenate([widen(x, k) for x, k in zip(table.column("ids").to_pylist(), n, strict=True)])
    counts = np.concatenate([np.frombuffer(x, np.uint32) if x else np.ones(k, np.uint32) for x, k in zip(table.column("counts").to_pylist(), n, strict=True)])
    source = np.repeat(np.repeat(np.arange(len(n)), n), counts)
    size = width + length - 1
    at = np.cumsum(size) - size
    h = span_hashes(data, at, at + size, MULTIPLIERS[1])
    gone = np.zeros(len(size), np.uint32)
    # Parts with about shard_bytes each; all windows of an anchor are in one part.
    parts = max(1, len(data) // shard_bytes)
    share = part % parts
    for p in range(parts):
        mine = np.flatnonzero(share == p)
        if not len(mine):
            continue
        mine = mine[np.lexsort((ids[mine], h[mine]))]
        new = _different(data, at[mine], size[mine], h[mine])
        heads = mine[new]
        least = np.repeat(ids[heads], width[heads])
        # Equal windows have one anchor: where only one piece has it, its windows are in no other piece.
        _, anchor, pieces = np.unique(part[heads], return_inverse=True, return_counts=True)
        several = pieces[anchor] > 1
        if several.any():
            some = heads[several]
            span = size[some] + 1
            start = np.cumsum(span) - span
            string = np.full(int(span.sum()), BETWEEN, np.uint8)
            inside = np.arange(int(size[some].sum())) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
            string[inside + np.repeat(start, size[some])] = data[inside + np.repeat(at[some], size[some])]
            least[np.repeat(several, width[heads])] = _least_ids(string, start, width[some], ids[some], length)
        # For each piece sent, which of its windows start in a document with a smaller id, as bits.
        which = np.cumsum(new) - 1
        first = np.cumsum(width[heads]) - width[heads]
        step = np.arange(int(width[mine].sum())) - np.repeat(np.cumsum(width[mine]) - width[mine], width[mine])
        lower = least[step + np.repeat(first[which], width[mine])] < np.repeat(ids[mine], width[mine])
        bits = np.where(lower, np.uint32(1) << step.astype(np.uint32), np.uint32(0))
        gone[mine] = np.bitwise_or.reduceat(bits, np.cumsum(width[mine]) - width[mine])
    gone = np.repeat(gone, counts)
    hit = np.flatnonzero(gone)
    batches = table.column("__batch").to_pylist()
    rows = [(batches[source[hit[a]]], place[hit[a:b]].tobytes(), gone[hit[a:b]].tobytes()) for a, b in zip(*cuts(source[hit]), strict=True)]
    return packed_table(rows, GONE)


def _kept(table: pa.Table, removed: pa.Table, length: int, keep: tuple[str, ...], as_text: bool) -> pa.Table:
    batch = Batch(table)
    place, bits = (np.frombuffer(b"".join(removed.column(c).to_pylist()), np.uint32) for c in ("places", "windows"))
    at, step = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"))
    start = place[at].astype(np.int64) + step
    steps = np.bincount(start, minlength=len(batch.raw) + 1) - np.bincount(start + length, minlength=len(batch.raw) + 1)
    gone = np.cumsum(steps[:-1]) > 0
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    head[batch.at[:-1][batch.at[:-1] < len(gone)]] |= gone[batch.at[:-1][batch.at[:-1] < len(gone)]]
    lost, spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[batch.at]) for x in (gone, head))
    size = np.diff(batch.at)
    offsets = np.concatenate([[0], np.cumsum(size - lost)]).astype(np.int64)
    data = batch.raw[~gone].tobytes()
    if as_text:
        kept = pa.array([data[a:b].decode("utf-8", "ignore") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())
    else:
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]).cast(pa.binary())
    columns = [*[batch.table.column(c) for c in keep], pa.array(size, pa.int64()), pa.array(lost, pa.int64()), pa.array(spans, pa.int64()), kept]
    return pa.table(columns, [*keep, *COUNTS])


def remove_repeated_bytes(
    docs: DataFrame, length: int = 50, keep: tuple[str, ...] = ("doc_id",), hot_bytes: int = 1 << 18, batch_bytes: int = 1 << 20, shard_bytes: int = 1 << 20, as_text: bool = False
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (but those named as new ones), with n_bytes, n_removed, n_spans (maximal runs removed) and kept (binary).

    ``length``: of a repeated string, up to ANCHOR + 31 bytes; ``batch_bytes``, ``shard_bytes`` and, for the pieces of one anchor,
    ``hot_bytes`` bound what is worked on at a time; ``as_text``: what is kept as a string, without parts of characters that were cut.
    """
    if not ANCHOR < length <= ANCHOR + 31:
        raise ValueError(f"length must be {ANCHOR + 1} to {ANCHOR + 31}")
    keep = tuple(c for c in keep if c not in COUNTS)
    rows, total = in_batches(docs.select(*dict.fromkeys(["doc_id", "text", *keep])), batch_bytes)
    # Each batch writes to each bucket, so messages grow with the square of the table; buckets as large as a task can hold keep them few.
    n_buckets = int(max(shuffle_partitions(docs.sparkSession), total // (BUCKET * shard_bytes)))
    hot = max(1, hot_bytes // (2 * length - ANCHOR))
    by_batch = rows.groupBy("__batch")
    live = by_batch.applyInArrow(lambda key, t: _anchors(key, t, length, n_buckets), ANCHORS).groupBy("__bucket").applyInArrow(lambda key, t: _live(key, t, hot), LIVE)
    pieces = by_batch.cogroup(live.groupBy("__batch")).applyInArrow(lambda key, t, hits: _pieces(key, t, hits, length, n_buckets), PIECES)
    removed = pieces.groupBy("__bucket").applyInArrow(lambda key, t: _shard(key, t, length, shard_bytes), GONE).groupBy("__batch")
    schema = "".join(f"`{c}` {kind}, " for c, kind in rows.select(*keep).dtypes) + f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"
    return by_batch.cogroup(removed).applyInArrow(lambda key, t, gone: _kept(t, gone, length, keep, as_text), schema)


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` with what is kept as text; of a character that was cut in two, no part is kept. n_chars, where it is there, is counted anew."""
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    found = remove_repeated_bytes(rows, length, keep=("row",), as_text=True)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op9_suffix_array": op9_suffix_array}
ORACLE: dict[str, str] = {}
