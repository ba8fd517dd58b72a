"""Substring dedup with fixed-block anchors.

A window of ``window`` words (13) always holds a whole block of ``window // 2 + 1`` words (7) of a cut of the document into blocks that
don't overlap. So the blocks of all documents form the index, and every rolling run of 7 words of every document probes it:

1. probe: each batch of documents sends the hashes of its rolling runs to hash buckets, marked where the run is also a block;
2. hit: a bucket answers which runs are a block somewhere and occur in a second document;
3. extend: a hit grows to both sides as long as the next run, too, occurs in a second document, to a stretch of words; the 13-word
   windows of a stretch are compared by the 128 bits of two hashes of their words, each with the smallest doc_id that has it. Windows that
   are repeated and touch are the maximal exact repeats;
4. remove: each document drops the words covered by a window that also starts in a document with a smaller doc_id.

All candidates are kept, however many documents share a passage: a value costs one entry for each batch, and no pairs are formed.

Defined results: a null text has no words; a null doc_id comes after all others; rows with one doc_id are one document for the comparison
and stay separate rows; an empty table gives an empty result; texts are taken whole, of any length; ``keep`` names further columns to carry,
of which those named n_words, n_removed or kept give way to the new ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.batches import MULTIPLIERS, Batch, buckets_of, covered, cuts, in_batches, narrow, packed_table, rolling_hashes, widen, word_hashes
from meridian.llm.common import documents, shuffle_partitions

PROBE = "__bucket long, __batch long, n int, hashes binary, blocks binary, shared binary"
HIT = "__batch long, __bucket long, n int, live binary, shared binary"
EXTEND = "__bucket long, __batch long, n int, hashes binary, ids binary, places binary"
REMOVE = "__batch long, places binary"
COUNTS = ("n_words", "n_removed", "kept")


class _Runs:
    """The rolling runs of a batch by ascending hash; documents too short for a window take no part."""

    def __init__(self, batch: Batch, window: int):
        self.size = window // 2 + 1
        starts, ends, row = batch.words()
        self.words, self.second = word_hashes(batch.raw, starts, ends)
        runs = rolling_hashes(self.words, self.size, MULTIPLIERS[1])
        n = len(runs)
        long_enough = np.diff(batch.first) >= window
        good = (row[:n] == row[self.size - 1 : self.size - 1 + n]) & long_enough[row[:n]]
        self.place = np.flatnonzero(good)
        runs, rows = runs[good], row[self.place]
        self.block = (self.place - batch.first[rows]) % self.size == 0
        order = np.argsort(runs, kind="stable")
        self.of = order  # place among the good runs, by ascending hash
        hashes = runs[order]
        self.start, self.stop = cuts(hashes)
        self.hash = hashes[self.start]
        self.rows = rows

    def messages(self, batch: Batch, key: int, n_buckets: int) -> list[tuple]:
        if not len(self.hash):
            return []
        low, high = batch.ids[self.rows[self.of[self.start]]], batch.ids[self.rows[self.of[self.stop - 1]]]  # rows are sorted by id
        shared = low != high
        block = np.logical_or.reduceat(self.block[self.of], self.start)
        low32, buckets = self.hash.astype(np.uint32), buckets_of(self.hash, n_buckets)
        return [
            (int(buckets[a]), key, int(b - a), low32[a:b].tobytes(), np.packbits(block[a:b]).tobytes(), np.packbits(shared[a:b]).tobytes())
            for a, b in zip(*cuts(buckets), strict=True)
        ]


def _probe(key: tuple, table: pa.Table, window: int, n_buckets: int) -> pa.Table:
    batch = Batch(table)
    return packed_table(_Runs(batch, window).messages(batch, key[0].as_py(), n_buckets), PROBE)


def _hit(key: tuple, table: pa.Table) -> pa.Table:
    """Which entries of the messages to one bucket are live, a block somewhere and in two documents at least, and which are in two documents."""
    sizes = table.column("n").to_pylist()

    def joined(name: str, read) -> np.ndarray:
        return np.concatenate([read(x, n) for x, n in zip(table.column(name).to_pylist(), sizes, strict=True)])

    hashes = joined("hashes", lambda x, n: np.frombuffer(x, np.uint32))
    block = joined("blocks", lambda x, n: np.unpackbits(np.frombuffer(x, np.uint8), count=n).view(bool))
    shared = joined("shared", lambda x, n: np.unpackbits(np.frombuffer(x, np.uint8), count=n).view(bool))
    order = np.argsort(hashes, kind="stable")
    start, stop = cuts(hashes[order])
    twice = np.logical_or.reduceat(shared[order], start) | (stop - start > 1)
    live, again = np.empty(len(hashes), bool), np.empty(len(hashes), bool)
    live[order] = np.repeat(twice & np.logical_or.reduceat(block[order], start), stop - start)
    again[order] = np.repeat(twice, stop - start)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    rows = [
        (b, key[0].as_py(), n, np.packbits(live[i : i + n]).tobytes(), np.packbits(again[i : i + n]).tobytes())
        for b, n, i in zip(table.column("__batch").to_pylist(), sizes, bounds[:-1], strict=True) if again[i : i + n].any()
    ]
    return packed_table(rows, HIT)


def _stretches(runs: _Runs, live: np.ndarray, again: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Windows of the stretches: the live blocks, and the runs before and after them that have no gap and occur in a second document."""
    at = [np.zeros(n_words + 1, bool) for _ in range(2)]
    for out, value in zip(at, (live, again), strict=True):
        out[runs.place[runs.of]] = np.repeat(value, runs.stop - runs.start)
    blocks = np.zeros(n_words + 1, bool)
    blocks[runs.place[runs.block]] = True
    hit, grown = at[0] & blocks, at[1]
    edge = np.flatnonzero(np.diff(grown, prepend=False, append=False))
    start, stop = edge[::2], edge[1::2]
    hits = np.append(0, np.cumsum(hit))
    some = (hits[stop] > hits[start]) & (stop - start > window - runs.size)
    start, size = start[some], stop[some] - start[some] - (window - runs.size)
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _extend(key: tuple, table: pa.Table, hits: pa.Table, window: int, n_buckets: int) -> pa.Table:
    """Windows around the hits, sent to the buckets of their hashes; those repeated within the batch are settled here, and pass with a bucket below zero."""
    if not hits.num_rows:
        return packed_table([], EXTEND)
    batch = Batch(table)
    runs = _Runs(batch, window)
    buckets = buckets_of(runs.hash, n_buckets)
    live, again = np.zeros(len(runs.hash), bool), np.zeros(len(runs.hash), bool)
    for bucket, n, *bits in zip(*(hits.column(c).to_pylist() for c in ("__bucket", "n", "live", "shared")), strict=True):
        at = np.searchsorted(buckets, np.uint64(bucket))
        for out, x in zip((live, again), bits, strict=True):
            out[at : at + n] = np.unpackbits(np.frombuffer(x, np.uint8), count=n)
    place = _stretches(runs, live, again, len(batch.row), window)
    if not len(place):
        return packed_table([], EXTEND)
    h1 = rolling_hashes(runs.words, window, MULTIPLIERS[0])[place]
    h2 = rolling_hashes(runs.second, window, MULTIPLIERS[1])[place]
    order = np.lexsort((place, h2, h1))  # the places of equal windows ascend, and so do their ids
    h1, h2, place = h1[order], h2[order], place[order]
    ids = batch.ids[batch.row[place]]
    new = np.ones(len(place), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    least = np.repeat(ids[new], np.diff(np.append(np.flatnonzero(new), len(place))))
    here = ids > least
    number = key[0].as_py()
    rows = [(-1 - number % n_buckets, number, int(here.sum()), b"", b"", place[here].astype(np.uint32).tobytes())] if here.any() else []
    sent = ~here
    h1, h2, place, ids = h1[sent], h2[sent], place[sent].astype(np.uint32), ids[sent]
    to = buckets_of(h1, n_buckets)
    for a, b in zip(*cuts(to), strict=True):
        rows.append((int(to[a]), number, int(b - a), h1[a:b].astype(np.uint32).tobytes() + h2[a:b].tobytes(), narrow(ids[a:b]), place[a:b].tobytes()))
    return packed_table(rows, EXTEND)


def _remove(key: tuple, table: pa.Table) -> pa.Table:
    """Windows of one bucket that also start in a document with a smaller id."""
    if key[0].as_py() < 0:
        return table.select(["__batch", "places"])
    columns = [table.column(c).to_pylist() for c in ("__batch", "n", "hashes", "ids", "places")]
    sizes = np.array(columns[1])
    low = np.concatenate([np.frombuffer(x, np.uint32, n) for n, x in zip(columns[1], columns[2], strict=True)])
    high = np.concatenate([np.frombuffer(x, np.uint64, n, 4 * n) for n, x in zip(columns[1], columns[2], strict=True)])
    ids = np.concatenate([widen(x, n) for n, x in zip(columns[1], columns[3], strict=True)])
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    start = np.flatnonzero(new)
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], start), np.diff(np.append(start, len(order))))
    gone = ids > least
    at = np.concatenate([[0], np.cumsum(sizes)])
    rows = [(b, np.frombuffer(p, np.uint32)[gone[i : i + n]].tobytes()) for b, n, p, i in zip(columns[0], columns[1], columns[4], at[:-1], strict=True) if gone[i : i + n].any()]
    return packed_table(rows, REMOVE)


def _kept(table: pa.Table, removed: pa.Table, window: int, keep: tuple[str, ...]) -> pa.Table:
    batch = Batch(table)
    starts, ends, row = batch.words()
    places = [np.frombuffer(x, np.uint32) for x in removed.column("places").to_pylist()]
    gone = covered(np.concatenate(places).astype(np.int64), window, len(starts)) if places else np.zeros(len(starts), bool)
    last = np.zeros(len(starts), bool)  # the last word that is kept of each document has no space after it
    kept = np.flatnonzero(~gone)
    last[kept[np.flatnonzero(np.diff(row[kept], append=-1))]] = True
    # One byte after each word is turned into the space that joins it to the next.
    raw = np.append(batch.raw, np.uint8(0x20))
    space = kept[~last[kept]]
    raw[ends[space]] = 0x20
    steps = np.zeros(len(raw) + 1, np.int8)
    steps[starts[kept]] += 1
    stop = ends[kept] + ~last[kept]
    np.add.at(steps, stop, -1)
    mask = np.cumsum(steps[:-1], dtype=np.int8) > 0
    size = np.concatenate([[0], np.cumsum(mask[: len(batch.raw)])])[batch.at]
    data = raw[: len(batch.raw)][mask[: len(batch.raw)]].tobytes()
    n = len(batch.ids)
    texts = pa.LargeStringArray.from_buffers(n, pa.py_buffer(size.astype(np.int64).tobytes()), pa.py_buffer(data)).cast(pa.string())
    counts = np.diff(batch.first)
    lost = np.bincount(row[gone], minlength=n)
    return pa.table([*[batch.table.column(c) for c in keep], pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), texts], [*keep, "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = 13, keep: tuple[str, ...] = ("doc_id",), entries_each: int = 1 << 20, batch_bytes: int = 1 << 20) -> DataFrame:
    """The columns ``keep`` of ``docs``, with n_words, n_removed and kept (the words that stay, joined by one space).

    ``entries_each``: about as many entries meet in one bucket; ``batch_bytes``: text of one batch.
    """
    keep = tuple(c for c in keep if c not in COUNTS)
    rows, total = in_batches(docs.select(*dict.fromkeys(["doc_id", "text", *keep])), batch_bytes)
    n_buckets = int(max(shuffle_partitions(docs.sparkSession), total // 6 // entries_each))
    by_batch = rows.groupBy("__batch")
    probes = by_batch.applyInArrow(lambda key, docs: _probe(key, docs, window, n_buckets), PROBE)
    hits = probes.groupBy("__bucket").applyInArrow(lambda key, sent: _hit(key, sent), HIT)
    around = by_batch.cogroup(hits.groupBy("__batch")).applyInArrow(lambda key, docs, hit: _extend(key, docs, hit, window, n_buckets), EXTEND)
    removed = around.groupBy("__bucket").applyInArrow(lambda key, sent: _remove(key, sent), REMOVE)
    schema = "".join(f"`{c}` {kind}, " for c, kind in rows.select(*keep).dtypes) + "n_words long, n_removed long, kept string"
    return by_batch.cogroup(removed.groupBy("__batch")).applyInArrow(lambda key, docs, gone: _kept(docs, gone, window, keep), schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLE = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT rowid AS r, doc_id, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS words
           FROM (SELECT ROW_NUMBER() OVER () AS rowid, doc_id, text FROM documents)),
win AS (SELECT r, doc_id, i, array_to_string(list_slice(words, i, i + 12), ' ') AS gram
        FROM (SELECT r, doc_id, words, UNNEST(range(1, CAST(len(words) AS BIGINT) - 11)) AS i FROM w)),
firsts AS (SELECT gram, MIN(doc_id) AS least FROM win GROUP BY gram),
gone AS (SELECT DISTINCT r, i + k AS p FROM (SELECT r, i FROM win JOIN firsts USING (gram) WHERE doc_id > least), range(13) t(k)),
kept AS (SELECT e.r, e.p, e.word, g.p IS NOT NULL AS lost
         FROM (SELECT r, UNNEST(range(1, CAST(len(words) AS BIGINT) + 1)) AS p, UNNEST(words) AS word FROM w) e LEFT JOIN gone g ON e.r = g.r AND e.p = g.p),
texts AS (SELECT r, COUNT(*) AS n_words, COUNT(*) FILTER (lost) AS n_removed, COALESCE(string_agg(word, ' ' ORDER BY p) FILTER (NOT lost), '') AS kept
          FROM kept GROUP BY r)
SELECT doc_id, COALESCE(n_words, 0) AS n_words, COALESCE(n_removed, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256 FROM w LEFT JOIN texts USING (r)
"""
}
