"""SimHash near-dedup with anchor points from a covering code.

Fingerprints are compared only at anchors, the words of the binary Golay code of 23 bits, which covers every word within 3 bits. Two
fingerprints that differ in up to 4 bits have a word midway, within 2 bits of both, and that word has an anchor within 3: so each
fingerprint goes to every anchor within 3 + 2 bits of it (some 22), and each linked pair meets at one of them at least. Over ``blocks`` = 2
blocks of 23 bits, pairs of anchors take the place of one, with the bits over 3 shared: for many millions of fingerprints.

Equal fingerprints are one point. At an anchor the points are compared in square blocks of bounded size, split over tasks where an anchor
has many; what goes on is a spanning forest of the links, not all pairs.

Defined results: a null text has no words; a text with fewer words than a shingle is one shingle, one without words has fingerprint 0;
null doc_ids take part and are never the smallest unless no other is reachable; equal rows are separate rows; an empty table gives an empty
result. Texts are taken whole, of any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.batches import mixed, word_spans
from meridian.llm.common import documents, materialise, slices, text_bytes
from meridian.llm.components import components, with_least

SEED = 42
SLICE = 1 << 20
#: Length and covering radius of the binary Golay code, and its generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1.
BLOCK, RADIUS, GENERATOR = 23, 3, 0b110001110101
#: Points of an anchor that one task compares with each other.
MEET = 4096
#: Pairs of points of one anchor that are compared in one task, where only sizes near each other are.
PAIRS = 1 << 26
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The bits of each byte as the bytes of a number, so that up to 255 of them add up without carry.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def shingles(raw: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of n words (lower-cased A-Z, joined by a space; all words where there are fewer), and where each row's begin."""
    rows = len(at) - 1
    # A space after each row keeps the words of neighbouring rows apart.
    data = np.full(len(raw) + rows, 0x20, np.uint8)
    data[np.arange(len(raw)) + np.repeat(np.arange(rows), np.diff(at))] = _LOWER[raw]
    starts, ends, row = word_spans(data, at + np.arange(rows + 1))
    data[ends] = 0x20
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts] += 1
    steps[ends + 1] -= 1  # a word, and one space after it
    text = data[np.cumsum(steps[:-1], dtype=np.int8) > 0].tobytes()
    width = ends - starts + 1
    left = np.cumsum(width) - width
    right = left + width - 1
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    each = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    begin = np.cumsum(each) - each
    place = np.arange(each.sum()) - np.repeat(begin - first, each)
    last = np.minimum(place + n - 1, np.repeat(first + count - 1, each))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(left[place].tolist(), right[last].tolist(), strict=True)), np.uint64, len(place))
    return hashes, np.append(begin, len(hashes))


def distinct(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash of a row once, sorted, and where each row's begin."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((hashes, row))
    hashes = hashes[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))[: len(hashes)]  # rows are in order already
    return hashes[new], np.append(0, np.cumsum(np.bincount(row[new], minlength=len(begin) - 1)))


def majority(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each row the 64 bits that more than half of its hashes have set; 0 for a row without hashes."""
    count = np.diff(begin)
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        # Rows are cut into runs of at most 255 hashes, summed in lanes of a byte, and the runs of a row are added up.
        runs = -(-count[some] // 255)
        step = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        at = np.repeat(begin[some], runs) + 255 * step
        lanes = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(-1, 8)], at, axis=0)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(len(at), 64), np.cumsum(runs) - runs, axis=0, dtype=np.int64)
        bits = 2 * sums > count[some, None]
        out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], words: int, wide: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "text"]
        for part in slices(batch, "text", SLICE):
            hashes, begin = shingles(*text_bytes(part.column("text")), words)
            if wide:
                hashes, begin = distinct(hashes, begin)
            found = [majority(hashes, begin)]
            more = []
            if wide:
                found.append(majority(mixed(hashes), begin))
                same = [xxhash.xxh3_128_digest(hashes[i:j], SEED) for i, j in zip(begin[:-1], begin[1:], strict=True)]
                more = [pa.array(np.diff(begin)), pa.array(same, pa.binary())]
            names = [*rest, *["fp", "fp2"][: len(found)], *["size", "same"][: len(more)]]
            yield pa.record_batch([*[part.column(c) for c in rest], *[pa.array(x.view(np.int64)) for x in found], *more], names)


def fingerprints(docs: DataFrame, words: int = 4, wide: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the fingerprint ``fp`` as a signed number; ``wide``: of distinct shingles, with 64 further bits in ``fp2``, their number ``size`` and a hash ``same`` of them."""
    rows = docs.select(*keep, "text")
    schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes if c in keep)
    return rows.mapInArrow(lambda it: _fingerprint(it, words, wide), f"{schema}, fp long" + ", fp2 long, size long, same binary" * wide)


@cache
def _code() -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Syndromes of the lower 12 and upper 11 bits, and for each number of bits beyond RADIUS (0, 1, 2) the differences to the anchors: CSR by syndrome."""

    def remainder(word: int) -> int:
        while word.bit_length() >= GENERATOR.bit_length():
            word ^= GENERATOR << (word.bit_length() - GENERATOR.bit_length())
        return word

    unit = [remainder(1 << i) for i in range(BLOCK)]
    table = np.zeros(1 << BLOCK, np.int16)
    for i, x in enumerate(unit):
        table[1 << i : 2 << i] = table[: 1 << i] ^ x
    weight = np.bitwise_count(np.arange(1 << BLOCK, dtype=np.uint32))
    rings = []
    for low, high in ((0, RADIUS), (RADIUS + 1, RADIUS + 1), (RADIUS + 2, RADIUS + 2)):
        words = np.flatnonzero((weight >= low) & (weight <= high))
        words = words[np.argsort(table[words], kind="stable")]
        rings.append((words, np.searchsorted(table[words], np.arange(2049))))
    return table[: 1 << 12].copy(), table[np.arange(1 << 11) << 12].copy(), rings


def _near(block: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors with ``beyond`` bits over the covering radius from each 23-bit word: (index of the word, anchor). 0: within the radius."""
    low, high, rings = _code()
    syndrome = low[block & 0xFFF] ^ high[block >> 12]
    words, start = rings[beyond]
    count = start[syndrome + 1] - start[syndrome]
    at = np.repeat(np.arange(len(block)), count)
    step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    return at, block[at] ^ words[start[syndrome][at] + step]


def anchors(points: np.ndarray, blocks: int, first_bit: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of 64-bit points, as (index of the point, anchor): over one block of 23 bits, or over two of them."""
    cut = [((points >> np.uint64(first_bit + BLOCK * b)) & np.uint64((1 << BLOCK) - 1)).astype(np.int64) for b in range(blocks)]
    if blocks == 1:
        found = [_near(cut[0], k) for k in range(3)]
    else:
        found = []
        for i in range(3):
            at, one = _near(cut[0], i)
            for j in range(3 - i):
                again, two = _near(cut[1][at], j)
                found.append((at[again], one[again] << BLOCK | two))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def spanning(points: np.ndarray, most: int, label: np.ndarray | None = None, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Links between points (rows of 64-bit words) that differ in at most ``most`` bits: a spanning forest of them.

    With ``label``, only points of different labels are compared; ``every``: all their links instead of a forest.
    """
    n, parent, found = len(points), np.arange(len(points)), []
    for lo in range(0, n, 256):
        near = np.zeros((min(256, n - lo), n - lo), np.uint8)
        for lane in range(points.shape[1]):
            near += np.bitwise_count(points[lo : lo + 256, lane, None] ^ points[None, lo:, lane])
        a, b = np.nonzero(near <= most)
        a, b = a + lo, b + lo
        keep = a < b
        if label is not None:
            keep &= label[a] != label[b]
        a, b = a[keep], b[keep]
        if every:
            found.append((a, b))
            continue
        while len(a):
            x, y = parent[a], parent[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    if every:
        return (np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])) if found else (parent[:0], parent[:0])
    child = np.flatnonzero(parent != np.arange(n))
    return child, parent[child]


def _replicate(batches: Iterator[pa.RecordBatch], blocks: int, starts: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            points = part.column("fp").to_numpy().view(np.uint64)
            for k, start in enumerate(starts):
                # The lanes are taken as one number of 128 bits; a block may lie in either.
                lane = points if start < 64 else part.column("fp2").to_numpy().view(np.uint64)
                at, anchor = anchors(lane, blocks, start % 64)
                yield pa.record_batch([pa.array(anchor * len(starts) + k), *[c.take(pa.array(at)) for c in part.columns]], ["anchor", *part.schema.names])


def meetings(points: DataFrame, blocks: int, starts: tuple[int, ...] = (0,), least: float | None = None) -> DataFrame:
    """Each point at each of its anchors, with the square block (one, two) in which it is compared there: (anchor, one, two, ...).

    ``least``: only points whose column ``size`` is at least this share of the other's are compared; see ``_sized``.
    """
    spread = points.mapInArrow(lambda it: _replicate(it, blocks, starts), "anchor long, " + ", ".join(f"{c} {kind}" for c, kind in points.dtypes))
    if least is not None:
        return _sized(spread, least)
    # An anchor with more points than one task compares is cut into stripes, and each point goes to every pair with its own stripe.
    crowded = spread.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MEET).select("anchor", F.ceil(F.col("n") / (MEET / 2)).alias("__stripes"))
    # Documents with one fingerprint are dealt to different stripes, too.
    return _striped(spread, "anchor", crowded, [c for c in points.columns if c in ("fp", "doc_id")])


def _striped(rows: DataFrame, key: str, crowded: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` in the square blocks (one, two) of their key; ``crowded``: keys that are cut, and in how many ``__stripes``, by a hash of ``by``."""
    return _blocks(rows.join(crowded, key, "left"), by).select(key, "one", "two", *[c for c in rows.columns if c != key])


def _blocks(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows``, once for each pair of stripes (one, two) with their own; ``__stripes``: how many there are, or null."""
    mine = F.pmod(F.xxhash64(*by, F.lit(3)), F.col("__stripes"))
    pairs = F.when(F.col("__stripes").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("__stripes") - 1))
    spread = rows.withColumn("__mine", F.coalesce(mine, F.lit(0))).withColumn("__other", F.explode(pairs))
    return spread.select(F.least("__mine", "__other").alias("one"), F.greatest("__mine", "__other").alias("two"), *rows.columns)


def _sized(spread: DataFrame, least: float) -> DataFrame:
    """Points at their anchors (anchor, class, one, two, own, ...), for comparing those with sizes near each other.

    An anchor with more than PAIRS of these is cut into classes of size. Sizes that go together lie in one class or in neighbouring ones, so
    a point goes to its class, where it is ``own``, and to the one below. Only a class that is too large by itself is cut into stripes, and
    each point goes to every pair with its own. So a point goes to twice its anchors as the table grows, not to more and more stripes.
    """
    # A class is a little wider than it has to be, so that rounding can't take a pair two classes apart.
    sized = spread.withColumn("__class", F.floor(F.log("size") / math.log(1.01 / least)))
    full = spread.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * F.col("n") > 2 * PAIRS).select("anchor")
    counts = sized.join(F.broadcast(full), "anchor", "left_semi").groupBy("anchor", "__class").agg(F.count(F.lit(1)).alias("n"))
    of_anchor = Window.partitionBy("anchor").orderBy("__class").rangeBetween(1, 1)
    counts = counts.withColumn("__above", F.coalesce(F.first("n").over(of_anchor), F.lit(0)))
    work = counts.withColumn("__pairs", F.col("n") * (F.col("n") / 2 + F.col("__above")))
    stripes = F.when(F.col("__pairs") > PAIRS, F.ceil((F.col("n") + F.col("__above")) / (MEET / 2)))
    classes = F.map_from_entries(F.collect_list(F.struct("__class", stripes.alias("s"))))
    # A row for an anchor at most, of which a block has 4,096.
    crowded = F.broadcast(work.groupBy("anchor").agg(F.sum("__pairs").alias("__pairs"), classes.alias("__cut")).where(F.col("__pairs") > PAIRS).drop("__pairs"))
    rows = sized.join(crowded, "anchor", "left")
    both = F.array(F.col("__class"), F.col("__class") - 1)
    rows = rows.withColumn("class", F.explode(F.when(F.col("__cut").isNull(), F.array(F.lit(-2).cast("long"))).otherwise(both)))
    rows = rows.withColumn("own", F.col("__cut").isNull() | (F.col("class") == F.col("__class"))).withColumn("__stripes", F.try_element_at("__cut", "class"))
    # Where no point has the class below, no pair is looked for there.
    rows = rows.where(F.col("own") | F.map_contains_key("__cut", F.col("class")))
    return _blocks(rows, [c for c in spread.columns if c in ("fp", "doc_id")]).select("anchor", "class", "one", "two", "own", *[c for c in spread.columns if c != "anchor"])


def _links(table: pa.Table, most: int) -> pa.Table:
    points = np.unique(table.column("fp").to_numpy().view(np.uint64))
    a, b = spanning(points[:, None], most)
    return pa.table([pa.array(points[a].view(np.int64)), pa.array(points[b].view(np.int64))], ["a", "b"])


def fingerprint_links(points: DataFrame, most: int = 4, blocks: int = 1) -> DataFrame:
    """Links (a, b) that join all fingerprints (distinct, column fp) within ``most`` (at most 4) bits of each other: a forest for each anchor.

    ``blocks``: one block has 4,096 anchors, pairs of anchors of two blocks are 16.8 million; links are the same.
    """
    if most > 4:
        raise ValueError("anchors are laid out for up to 4 bits")
    met = meetings(points.select("fp"), blocks)
    return met.groupBy("anchor", "one", "two").applyInArrow(lambda t: _links(t, most), "a long, b long").distinct()


def near_duplicate_groups(docs: DataFrame, words: int = 4, most: int = 4, blocks: int = 1) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links of fingerprints) of each row of ``docs``."""
    prints = materialise(fingerprints(docs, words), "fingerprints")
    points = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = components(fingerprint_links(points, most, blocks))
    # Only linked points need a minimum over others. A component of any size is one root, so the minimum comes back by a salted join.
    nodes = roots.unionAll(roots.select("root", "root").distinct())
    linked = nodes.join(points, nodes["node"] == points["fp"]).select(F.col("root").alias("n"), F.col("fp").alias("x"), "least")
    of_root = linked.groupBy("n").agg(F.min("least").alias("m"))
    named = with_least(linked.select("n", "x"), of_root).select(F.col("x").alias("fp"), "m")
    # Written, so that Spark can split the documents of one fingerprint over tasks of the join.
    named = materialise(points.join(named, "fp", "left").select("fp", F.coalesce("m", "least").alias("component_id")), "components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


# --- near duplicates by similarity: wide fingerprints find, shingle sets decide ---

#: Bits of 128 in which wide fingerprints of candidates may differ: two shingle sets of similarity 0.8 differ in 19 on average, 4 standard.
CANDIDATE_BITS = 32
#: Blocks of 23 bits in the wide fingerprint whose anchors are visited; a pair of similarity 0.8 meets in one of the three with 98 %.
BLOCK_STARTS = (0, 23, 64)


#: Failed candidates of at least this similarity still tie their documents to one family, within which all pairs are tested.
FAMILY = 0.5
#: Bytes of shingles of a family that one task compares with each other, about.
SET_BYTES = 16 << 20


def _forest(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Places of the edges of a minimum spanning forest: each tree takes its lightest edge, until none is left."""
    label, key = np.arange(n), np.empty(len(w), np.int64)
    key[np.argsort(w, kind="stable")] = np.arange(len(w))  # all different, so that trees agree on what is lighter
    chosen, todo = np.zeros(len(w), bool), np.arange(len(w))
    while True:
        x, y = label[a[todo]], label[b[todo]]
        apart = x != y
        todo, x, y = todo[apart], x[apart], y[apart]
        if not len(todo):
            return np.flatnonzero(chosen)
        least = np.full(n, len(w), np.int64)
        np.minimum.at(least, x, key[todo])
        np.minimum.at(least, y, key[todo])
        mine = (key[todo] == least[x]) | (key[todo] == least[y])
        chosen[todo[mine]] = True
        x, y = x[mine], y[mine]
        parent = np.arange(n)
        while len(x):
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while (parent[parent] != parent).any():
                parent = parent[parent]
            x, y = parent[x], parent[y]
            x, y = x[x != y], y[x != y]
        label = parent[label]


def _by_size(table: pa.Table) -> pa.Table:
    return table.sort_by([("size", "ascending"), ("doc_id", "ascending")])


def _close(table: pa.Table, most: int, least: float, own: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of documents whose fingerprints differ in at most ``most`` bits, in blocks of 64 rows: places a < b, and the bits.

    The table is sorted by size. A pair of sets whose sizes rule out a similarity of ``least`` is left out, and such sizes are not gone
    through. ``own``: the first of a pair is one of so many first rows.
    """
    lanes = [table.column(c).to_numpy().view(np.uint64) for c in ("fp", "fp2")]
    size = table.column("size").to_numpy()
    reach = np.searchsorted(size, size / least + 1, "right")
    own = table.num_rows if own is None else own
    for lo in range(0, own, 64):
        hi = min(lo + 64, own)
        near = sum(np.bitwise_count(x[lo:hi, None] ^ x[None, lo : reach[hi - 1]]) for x in lanes)
        i, j = np.nonzero(near <= most)
        some = (i < j) & (size[i + lo] >= least * size[j + lo])
        i, j = i[some], j[some]
        yield i + lo, j + lo, near[i, j]


def _candidates(table: pa.Table, most: int, least: float) -> pa.Table:
    """The closest links of the documents that meet at an anchor: a minimum spanning forest by differing bits."""
    table = _by_size(table)  # a class has its own rows first
    ids, n = table.column("doc_id").to_numpy(), table.num_rows
    a = b = w = np.zeros(0, np.int64)
    for i, j, bits in _close(table, most, least, pc.sum(table.column("own")).as_py()):
        a, b, w = np.concatenate([a, i]), np.concatenate([b, j]), np.concatenate([w, bits])
        if len(a) > 4 * n:
            keep = _forest(a, b, w, n)
            a, b, w = a[keep], b[keep], w[keep]
    keep = _forest(a, b, w, n)
    a, b = ids[a[keep]], ids[b[keep]]
    return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _settle(table: pa.Table, most: int, least: float) -> pa.Table:
    """Links of a family's documents that join different roots. Each pair of different roots is tested, and a link that joins them is enough."""
    table = _by_size(table)
    ids, size = table.column("doc_id").to_numpy(), table.column("size").to_numpy()
    _, label = np.unique(table.column("root").to_numpy(), return_inverse=True)
    hashes = np.frombuffer(b"".join(table.column("shingles").to_pylist()), np.uint64)
    distinct, sign = np.unique(hashes, return_inverse=True)
    first, seen, found = np.cumsum(size) - size, np.zeros(len(distinct), bool), []
    for left, right, _ in _close(table, most, least):
        edge = np.append(0, np.flatnonzero(np.diff(left)) + 1) if len(left) else []
        for i, others in zip(left[edge], np.split(right, edge[1:]), strict=True) if len(left) else ():
            others = others[label[others] != label[i]]
            if not len(others):
                continue
            mine, n = sign[first[i] : first[i] + size[i]], size[others]
            begin = np.cumsum(n) - n
            seen[mine] = True
            both = np.add.reduceat(seen[sign[np.arange(int(n.sum())) + np.repeat(first[others] - begin, n)]], begin, dtype=np.int64)
            seen[mine] = False
            others = others[both >= least * (size[i] + n - both)]
            _, one = np.unique(label[others], return_index=True)
            found += [(ids[i], ids[j]) for j in others[one]]
            label[np.isin(label, label[others])] = label[i]
    a, b = (np.array(x, np.int64) for x in (zip(*found, strict=True) if found else ((), ())))
    return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            hashes, begin = distinct(*shingles(*text_bytes(part.column("text")), words))
            sets = [hashes[i:j].tobytes() for i, j in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.record_batch([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])


def _similar(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        share = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            whole = len(x) + len(y) - both
            # As whole numbers decide: 2 where the pair is similar, 1 where it is of one family.
            share.append(2 if both and both >= least * whole else 1 if both >= FAMILY * whole else 0)
        found = pa.record_batch([batch.column("a"), batch.column("b"), pa.array(share, pa.int32())], ["a", "b", "state"])
        yield found.filter(pc.greater(found.column("state"), 0))


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each group of near duplicates.

    Groups are joined by equal texts, equal sets of shingles and links of Jaccard similarity of ``similarity`` or more between sets of word
    shingles. Candidates come from the anchors of wide fingerprints, and the sets of shingles decide: first on the closest links of each
    anchor; where one of these fails, all pairs of its family that are not joined yet are tested in tasks. Rows with one doc_id are one
    document, with the smallest of its texts for comparison; rows with a null doc_id stay; a null text is an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # One document of each text; of equal texts the smallest doc_id, and one row of each doc_id.
    heads = named.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(F.min("doc_id").alias("doc_id"))
    heads = materialise(heads.groupBy("doc_id").agg(F.min("h").alias("h")), "heads")
    rows = named.withColumn("h", F.sha2(F.col("text").cast("binary"), 256)).join(heads, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id"])
    # Documents with equal sets are one point, that of the smallest doc_id; without a shingle they are like no other.
    prints = materialise(fingerprints(rows, words, wide=True).where("size > 0"), "wide-fingerprints")
    points = prints.groupBy("same").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("fp", "fp2", "size")]).drop("same")
    points = materialise(points, "points")
    met = meetings(points, 1, BLOCK_STARTS, similarity)
    links = met.groupBy("anchor", "class", "one", "two").applyInArrow(lambda t: _candidates(t, CANDIDATE_BITS, similarity), "a long, b long").distinct()
    links = materialise(links, "candidates")
    nodes = links.select(F.col("a").alias("doc_id")).unionAll(links.select("b")).distinct()
    sets = rows.join(nodes, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(lambda it: _sets(it, words), "doc_id long, shingles binary")
    sets = materialise(sets, "shingles")

    paired = links.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    paired = paired.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    tested = materialise(paired.mapInArrow(lambda it: _similar(it, similarity), "a long, b long, state int"), "tested")
    similar = tested.where("state = 2").select("a", "b")
    # A forest tells only what it joins. Where a link of it fails, other pairs may still hold: in a family, the documents tied by links that
    # hold or all but hold, every pair of different roots is tested, in blocks. What goes on is again a forest.
    whole = lambda links: materialise(nodes.join(c := components(links), nodes["doc_id"] == c["node"], "left").select("doc_id", F.coalesce("root", "doc_id").alias("root")), "roots")
    members = whole(tested.select("a", "b")).withColumnRenamed("root", "family").join(whole(similar), "doc_id").join(points, "doc_id")
    families = members.groupBy("family").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")).where("x <> y")
    stripes = F.ceil(F.greatest(F.col("n") / MEET, F.col("s") * 8 / SET_BYTES) * 2)
    families = materialise(families.select("family", F.when(F.greatest(F.col("n") / MEET, F.col("s") * 8 / SET_BYTES) > 1, stripes).alias("__stripes")), "families")
    unsettled = members.join(families.select("family"), "family", "left_semi").join(sets, "doc_id").select("family", "doc_id", "root", "fp", "fp2", "size", "shingles")
    blocks = _striped(unsettled, "family", families.where("__stripes is not null"), ["doc_id"])
    others = blocks.groupBy("family", "one", "two").applyInArrow(lambda t: _settle(t, CANDIDATE_BITS, similarity), "a long, b long")
    lost = components(similar.unionAll(others)).select(F.col("node").alias("doc_id")).unionAll(prints.select("doc_id").join(points.select("doc_id"), "doc_id", "left_anti"))
    kept = heads.select("doc_id").join(lost, "doc_id", "left_anti")
    return docs.where(F.col("doc_id").isNull()).unionByName(docs.join(kept, docs["doc_id"].cast("long") == kept["doc_id"], "left_semi"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash": op6_simhash}
ORACLE: dict[str, str] = {}
