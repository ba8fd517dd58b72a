"""BPE encoding and decoding with a public vocabulary; the vocabulary is read, never trained.

A text is split at special tokens, put into NFC, lower-cased and cut into pieces by the vocabulary's pattern; each piece is spelt in byte
signs, the last with the end-of-word sign. Merges of a piece follow a segment tree over the ranks of its neighbouring pairs: the root is
the leftmost pair of the lowest rank; it is merged, and the leaves of the pairs around it are updated on the way to the root, until no
pair can be merged. The distinct pieces of some texts are worked on together, one merge of each at a time; long ones one by one.

Defined results: a null text is the empty one and gives no token; equal rows are separate rows; texts are encoded whole, of any length; a
character that the vocabulary can't spell is left out; ids outside the vocabulary raise ``KeyError``; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, slices

SLICE = 1 << 20
#: Pieces kept with their ids between slices, at most.
KNOWN = 100_000
#: Longest piece (in signs) that is merged together with others.
SHORT = 64
NONE = np.iinfo(np.int64).max
#: Fixed values of the vocabulary's format: its pattern for pieces, and its end-of-word sign.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
END = "</w>"

#: Ranges of letters and numbers that the format's Unicode version has beyond those of Python's tables.
NEWER = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CE), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x16EA0, 0x16EB8), (0x18CFF, 0x18CFF),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)

#: Capitals that the format's Unicode version has beyond those of Python's tables, and their small letters.
NEWER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_signs() -> list[str]:
    """The printable sign of each byte: itself where it prints in Latin-1, else the next free code point from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    signs, free = [], 0x100
    for b in range(256):
        signs.append(chr(b if b in prints else free))
        free += b not in prints
    return signs


def _steps(size: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n in ``size``, end to end."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


@cache
def _unassigned() -> str:
    """Ranges of characters that the pattern's engine here counts as letters or numbers, but the format's older Unicode version does not."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    codes = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn" and not any(a <= ord(c) <= b for a, b in NEWER)]
    runs: list[list[int]] = []
    for c in codes:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ids = data["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.size = max(tokens) + 1
        self.token_table = np.array([tokens.get(i) for i in range(self.size)], object)
        # Spelling: the id of each byte inside a word and at its end; -1 where the vocabulary lacks it.
        self.inner = np.array([ids.get(s, -1) for s in byte_signs()], np.int64)
        self.last = np.array([ids.get(s + END, -1) for s in byte_signs()], np.int64)
        pairs = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks, self.made = pairs[order], order, made
        self.pieces = regex.compile(PIECE)
        new = _unassigned()
        self.odd = regex.compile(f"[{new}]" if new else r"(?!)")
        self.careful = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|(?:(?![{new}])\p{{L}})+|(?![{new}])\p{{N}}|(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{new}])+") if new else self.pieces
        self.capitals = regex.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, int] = {}
        self.ids, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or NONE."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def spell(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the byte signs of all pieces, end to end, and the number of each piece."""
        raw = np.frombuffer(("\n".join(pieces) + "\n").encode("utf-8"), np.uint8)  # no piece has white space in it
        stop = np.flatnonzero(raw == 0x0A)
        ids = self.inner[raw]
        ids[stop - 1] = self.last[raw[stop - 1]]
        ids[stop] = -1
        keep = ids >= 0
        return ids[keep], np.diff(np.concatenate([[0], np.cumsum(keep)])[np.append(0, stop + 1)])

    def merge_together(self, ids: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of at most ``width`` signs (a power of two): row by row the same tree, all rows a merge at a time."""
        n = len(size)
        symbol = np.full((n, width + 1), -1, np.int64)
        symbol[np.repeat(np.arange(n), size), _steps(size)] = ids
        place = np.arange(width)
        after = np.broadcast_to(place + 1, (n, width)).copy()  # the next sign that is left; ``width``: none
        after[after >= size[:, None]] = width
        before = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        there = np.flatnonzero((after < width).ravel())
        r, i = there // width, there % width
        rank = self.rank(symbol[r, i], symbol[r, i + 1])
        # A leaf is rank and place, so that the least one is the leftmost of the lowest rank.
        tree[r, width + i] = np.where(rank == NONE, NONE, rank * width + i)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            i = root % width
            j = after[rows, i]
            symbol[rows, i] = self.made[root // width]
            symbol[rows, j] = -1
            k = after[rows, j]
            after[rows, i] = k
            some = k < width
            before[rows[some], k[some]] = i[some]
            h = before[rows, i]
            leaf = lambda a, b, r: np.where(b < width, self._leaf(symbol[r, a], symbol[r, np.minimum(b, width)], a, width), NONE)
            tree[rows, width + j] = NONE
            tree[rows, width + i] = leaf(i, k, rows)
            left = np.flatnonzero(h >= 0)
            tree[rows[left], width + h[left]] = leaf(h[left], i[left], rows[left])
            r, node = np.concatenate([rows, rows, rows[left]]), (np.concatenate([i, j, h[left]]) + width) >> 1
            while node[0]:
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                node >>= 1
            rows = rows[tree[rows, 1] != NONE]
        left = symbol[:, :width]
        return left[left >= 0], (left >= 0).sum(axis=1)

    def _leaf(self, a: np.ndarray, b: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        rank = self.rank(a, b)
        return np.where(rank == NONE, NONE, rank * width + place)

    def merge_one(self, ids: np.ndarray) -> np.ndarray:
        """The same for one long piece, with a tree in plain lists."""
        n = len(ids)
        width = 1 << max(1, (n - 1).bit_length())
        symbol, after, before = ids.tolist(), [*range(1, n), -1], list(range(-1, n - 1))
        rank = self.rank(ids[:-1], ids[1:])
        tree = [NONE] * (2 * width)
        tree[width : width + n - 1] = np.where(rank == NONE, NONE, rank * width + np.arange(n - 1)).tolist()
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        lookup = dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def leaf(i: int) -> int:
            found = lookup.get(symbol[i] * self.size + symbol[after[i]]) if after[i] >= 0 else None
            return NONE if found is None else found * width + i

        while tree[1] != NONE:
            i = tree[1] % width
            j = after[i]
            symbol[i], symbol[j], after[i] = int(self.made[tree[1] // width]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            put(j, NONE)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        return np.array([s for s in symbol if s >= 0], np.int64)

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, end to end, and the number of each."""
        ids, size = self.spell(pieces)
        at = np.cumsum(size) - size
        parts = [(np.flatnonzero(size == 1), ids[at[size == 1]], np.ones(int((size == 1).sum()), np.int64))]
        width, low = 4, 1
        while low < SHORT:
            of = np.flatnonzero((size > low) & (size <= width))
            for k in range(0, len(of), 1 << 13):
                some = of[k : k + (1 << 13)]
                parts.append((some, *self.merge_together(ids[_steps(size[some]) + np.repeat(at[some], size[some])], size[some], width)))
            low, width = width, 2 * width
        for k in np.flatnonzero(size > SHORT):
            one = self.merge_one(ids[at[k] : at[k] + size[k]])
            parts.append((np.array([k]), one, np.array([len(one)])))
        made = np.zeros(len(size), np.int64)
        for of, _, n in parts:
            made[of] = n
        start = np.cumsum(made) - made
        out = np.empty(int(made.sum()), np.int64)
        for of, found, n in parts:
            out[_steps(n) + np.repeat(start[of], n)] = found
        return out, made

    def _lowered(self, text: str) -> tuple[str, regex.Pattern]:
        """``text`` with each character lower-cased by itself (a final sigma is not special), and the pattern for its pieces."""
        text = text.replace("Σ", "σ").lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.capitals.search(text):
                text = text.translate(NEWER_LOWER)
            return text, self.careful if self.odd.search(text) else self.pieces
        return text, self.pieces

    def cut(self, text: str) -> list[str]:
        """Pieces of a text; special tokens stand as they are (no piece looks like one, as a piece has letters, a digit or neither)."""
        out: list[str] = []
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2:
                out.append(part)
            elif part:
                part, pieces = self._lowered(unicodedata.normalize("NFC", part))
                out += pieces.findall(part)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the offsets of each text."""
        if len(self.known) > KNOWN:
            self.known, self.ids, self.at = {}, np.zeros(0, np.int64), np.zeros(1, np.int64)
        cut = [self.cut(t) if t else [] for t in texts]
        known, before = self.known, len(self.known)
        slot = np.fromiter((known.setdefault(p, len(known)) for p in chain.from_iterable(cut)), np.int64)
        if len(known) > before:
            fresh = list(islice(known, before, None))
            ids, n = self.merged(fresh)
            special = [k for k, p in enumerate(fresh) if p in self.special]
            if special:  # a special token is one id, whatever its letters would give
                at = np.cumsum(n) - n
                keep = np.ones(len(ids), bool)
                for k in special:
                    keep[at[k] + 1 : at[k] + n[k]] = False
                    ids[at[k]], n[k] = self.special[fresh[k]], 1
                ids = ids[keep]
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(n)])
            self.ids = np.concatenate([self.ids, ids])
        size = self.at[slot + 1] - self.at[slot]
        start = np.cumsum(size) - size
        ids = self.ids[_steps(size) + np.repeat(self.at[slot], size)]
        pieces = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        return ids, np.append(start, len(ids))[pieces]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens, joined by a space: the vocabulary states no decoder, and the end-of-word sign stays."""
        if len(ids) and (int(ids.max()) >= self.size):
            raise KeyError(int(ids.max()))
        return " ".join(self.token_table[ids].tolist())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    words = vocabulary(path)
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "text"]
        for part in slices(batch, "text", SLICE):
            ids, at = words.encode(part.column("text").to_pylist())
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer((4 * at).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.record_batch([*[part.column(c) for c in rest], pa.array(np.diff(at)), data.cast(pa.binary())], [*rest, "n_tokens", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    words = vocabulary(path)
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "ids"]
        for part in slices(batch, "ids", 2 * SLICE):
            texts = [None if x is None else words.decode(np.frombuffer(x, "<u4")) for x in part.column("ids").to_pylist()]
            yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"]).select([*rest, "ids", "decoded"])


#: New columns; one of these names that is to be kept is left out.
NEW = ("n_tokens", "ids", "decoded")


def _schema(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes if c in names)


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` (but those named as new ones) with n_tokens and ids: token ids as little-endian unsigned 32-bit integers."""
    keep = tuple(c for c in keep if c not in NEW)
    rows = docs.select(*keep, "text")
    return rows.mapInArrow(lambda it: _encode(it, path), f"{_schema(rows, list(keep))}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids."""
    rest = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(*rest, "ids").mapInArrow(lambda it: _decode(it, path), f"{_schema(encoded, rest)}, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """What ``decode(encode(docs))`` gives, in one pass: a slice of texts is decoded by the worker that encoded it, so no batch of ids waits."""
    keep = tuple(c for c in keep if c not in NEW)
    rows = docs.select(*keep, "text")
    return rows.mapInArrow(lambda it: _decode(_encode(it, path), path), f"{_schema(rows, list(keep))}, n_tokens long, ids binary, decoded string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_vocabulary()
    found = round_trip(documents(spark, sf_dir), path)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {"op7_bpe": op7_bpe}
ORACLE: dict[str, str] = {}
