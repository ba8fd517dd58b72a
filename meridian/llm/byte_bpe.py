"""Byte-level BPE with a public rank file; the ranks are read, never trained.

A text is cut into pieces by the vocabulary's pattern, and each piece is encoded by itself. Its bytes stand as Latin-1 characters, so that an
Aho-Corasick automaton over the tokens gives the longest token at each place. From the left the longest one is taken that fits the token
before it; where none fits, the place is marked dead, and the token before it gives way to the next shorter one. Two tokens fit if the merges
of both together leave the border between them alone; that is read off their splits and memoised. A row of tokens in which all neighbours fit
is what the merges by rank would give, and each place is tried once for each length of token, so the work is linear in the piece.

Defined results: a null text is the empty one and gives no token; equal rows are separate rows; texts and pieces are encoded whole, of any
length; ids outside the vocabulary raise ``KeyError``, and a rank file that lacks a byte, or has a token of a lower rank than its parts,
raises ``ValueError``; an empty table gives an empty result; columns named as new ones are replaced.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, slices

SLICE = 1 << 20
#: Pieces kept with their ids between slices, and pairs of tokens with their verdict, at most.
KNOWN, PAIRS = 500_000, 1_000_000
NEVER = 1 << 62
#: New columns; one of these names that is to be kept is left out.
NEW = ("n_tokens", "ids", "decoded")
#: Ranges of letters and numbers that the format's Unicode version (16) has beyond that of Python's tables (15.1).
NEWER = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def _unassigned() -> str:
    """Characters that the pattern's engine here counts as letters or numbers, but the format's older Unicode version doesn't, as a class."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    codes = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn" and not any(a <= ord(c) <= b for a, b in NEWER)]
    first = [c for c, before in zip(codes, [-1, *codes], strict=False) if c != before + 1]
    last = [c for c, after in zip(codes, [*codes[1:], -1], strict=True) if c != after - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True))


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks: a line has a token in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Slots(dict):
    """Numbers of pieces in the order in which they are met."""

    def __missing__(self, piece: str) -> int:
        slot = self[piece] = len(self)
        return slot


class Ranks:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the rank file lacks a byte")
        self.size = max(ranks.values()) + 1
        self.token: list[bytes | None] = [None] * self.size
        for t, r in ranks.items():
            self.token[r] = t
        self.length = [len(t or b"") for t in self.token]
        self.lengths = np.array(self.length)
        self.bytes, self.first = np.frombuffer(b"".join(t or b"" for t in self.token), np.uint8), np.cumsum(self.lengths) - self.lengths
        #: The two parts whose merge makes a token (none for a byte), the token of two parts, and the next shorter token it begins with.
        self.left, self.right, self.pair = [-1] * self.size, [-1] * self.size, {}
        self.shorter = array("i", [-1] * self.size)
        self.verdicts: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for t, r in sorted(ranks.items(), key=lambda x: x[1]):
            if len(t) > 1 and not self._learn(t, r):
                continue  # no merges lead to it: it only stands for a piece that it is as a whole
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        for t, r in ranks.items():
            found = (ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in ranks)
            self.shorter[r] = next((s for s in found if self.length[s] == 1 or self.left[s] >= 0), -1)
        self.verdicts.clear()
        self.pieces = regex.compile(pattern)
        # The engine here knows letters and numbers of a newer Unicode than the format's: these are other characters in the pattern.
        new = _unassigned()
        self.odd = regex.compile(f"[{new}]" if new else r"(?!)")
        careful = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{new}])")
        careful = careful.replace(r"\p{L}+", rf"(?:(?![{new}])\p{{L}})+").replace(r"\p{N}+", rf"(?:(?![{new}])\p{{N}})+")
        self.careful = regex.compile(careful) if new else self.pieces
        self.known = Slots()
        self.ids, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, token: bytes, rank: int) -> bool:
        """Find the two parts of a token: those that fit each other by the merges of lower ranks."""
        ranks = self.ranks
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is None or b is None or not (self._made(a) and self._made(b)):
                continue
            if self._border_stays(a, b):
                if max(self._age(a), self._age(b)) > rank:
                    raise ValueError("a token has a lower rank than its parts")
                self.left[rank], self.right[rank], self.pair[a * self.size + b] = a, b, rank
                return True
        return False

    def _made(self, t: int) -> bool:
        return self.length[t] == 1 or self.left[t] >= 0

    def _age(self, t: int) -> int:
        """When merges make a token: at its rank; a byte is there from the start."""
        return -1 if self.left[t] < 0 else t

    def _border_stays(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of two tokens: merges are undone from the last to the first, on the side that was made later.

        A pair at the border is open until one of its two is merged away; of equal ranks the left one is merged first.
        """
        until_a = until_b = NEVER
        while True:
            made = self.pair.get(a * self.size + b, NEVER)
            if made < until_a and made <= until_b and made < NEVER:
                return False
            if self._age(a) < 0 and self._age(b) < 0:
                return True
            if self._age(a) > self._age(b):
                until_a, a = a, self.right[a]
            else:
                until_b, b = b, self.left[b]

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a in a piece."""
        key = a * self.size + b
        if key not in self.verdicts:
            if len(self.verdicts) >= PAIRS:
                self.verdicts.clear()
            self.verdicts[key] = self._border_stays(a, b)
        return self.verdicts[key]

    def _matches(self, text: str, longest: bool) -> tuple[np.ndarray, np.ndarray]:
        """First place and token of the matches in a text: all, by their ends, or only the longest one at each place that is reached."""
        found = (self.automaton.iter_long if longest else self.automaton.iter)(text)
        ends = np.fromiter(found, np.dtype([("end", np.int64), ("token", np.int64)]))
        return ends["end"] + 1 - self.lengths[ends["token"]], ends["token"]

    def _all_fit(self, tokens: np.ndarray) -> np.ndarray:
        """Whether each token but the first fits the one before it."""
        keys, of = np.unique(tokens[:-1] * self.size + tokens[1:], return_inverse=True)
        return np.array([self.fits(k // self.size, k % self.size) for k in keys.tolist()], bool)[of]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, end to end, and the number of each. The longest tokens are taken where they fit; other pieces go back from them."""
        text = "\u0100".join([p.decode("latin-1") for p in pieces]) + "\u0100"  # no byte, so no token crosses it
        size = np.array([len(p) for p in pieces], np.int64)
        start = np.cumsum(size + 1) - size - 1
        at, tokens = self._matches(text, longest=True)
        of = np.searchsorted(start, at, "right") - 1
        whole = np.bincount(of, self.lengths[tokens], len(pieces)) == size
        if len(tokens) > 1:
            wrong = (of[1:] == of[:-1]) & ~self._all_fit(tokens)
            whole[of[1:][wrong]] = False
        ids = self.ranks.get
        direct = {k: [ids(pieces[k])] if ids(pieces[k]) is not None else self._back(pieces[k]) for k in np.flatnonzero(~whole).tolist()}
        count = np.bincount(of, minlength=len(pieces))
        count[list(direct)] = [len(x) for x in direct.values()]
        stop = np.cumsum(count)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.int32)
        keep = whole[of]
        out[np.repeat(whole, count)] = tokens[keep]
        out[np.repeat(~whole, count)] = np.fromiter(chain.from_iterable(direct.values()), np.int32)
        return out, count

    def _back(self, piece: bytes) -> list[int]:
        """Ids of one piece by backtracking from the longest tokens."""
        length, shorter, size, known, n = self.length, self.shorter, self.size, self.verdicts, len(piece)
        longest = array("i", bytes(4 * n + 4))
        for end, t in self.automaton.iter(piece.decode("latin-1")):  # ends ascend, so a longer token of one place comes later
            longest[end + 1 - length[t]] = t
        dead, at, ids = bytearray(n + 1), 0, []
        t = longest[0]
        while at < n:
            while t >= 0:
                end = at + length[t]
                if not dead[end]:
                    if not ids:
                        break
                    fits = known.get(ids[-1] * size + t)
                    if fits if fits is not None else self.fits(ids[-1], t):
                        break
                t = shorter[t]
            if t >= 0:
                ids.append(t)
                at = end
                t = longest[at]
            else:
                dead[at] = 1
                t = ids.pop()
                at -= length[t]
                t = shorter[t]
        return ids

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")  # far quicker than a search
        except UnicodeEncodeError:
            if self.odd.search(text):
                return self.careful.findall(text)
        return self.pieces.findall(text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the offsets of each text. Pieces that were met before are looked up."""
        if len(self.known) > KNOWN:
            self.known, self.ids, self.at = Slots(), np.zeros(0, np.int32), np.zeros(1, np.int64)
        cut = [self.cut(t) if t else [] for t in texts]
        known, before = self.known, len(self.known)
        slot = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64)
        if len(known) > before:
            ids, n = self.encode_pieces([p.encode("utf-8") for p in islice(known, before, None)])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(n)])
            self.ids = np.concatenate([self.ids, ids])
        size = self.at[slot + 1] - self.at[slot]
        end = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(end[-1]) + np.repeat(self.at[slot] - end[:-1], size)]
        pieces = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        return ids, end[pieces]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the tokens of some rows, end to end, and their offsets; they need not be UTF-8. ``at``: offsets of the rows in ``ids``."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= self.size or not self.lengths[ids].all()):
            raise KeyError("an id is not in the vocabulary")
        size = self.lengths[ids]
        end = np.concatenate([[0], np.cumsum(size)])
        step = np.arange(int(end[-1])) - np.repeat(end[:-1], size)
        return self.bytes[np.repeat(self.first[ids], size) + step], end[at]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Ranks:
    return Ranks(read_ranks(path), pattern)


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    ranks = vocabulary(path, pattern)
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "text"]
        for part in slices(batch, "text", SLICE):
            ids, at = ranks.encode(part.column("text").to_pylist())
            if at[-1] > np.iinfo(np.int32).max:
                raise ValueError("a text has more tokens than one row can hold")
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.record_batch([*[part.column(c) for c in rest], pa.array(np.diff(at)), lists], [*rest, "n_tokens", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    ranks = vocabulary(path, pattern)
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        missing = lists.is_null().to_numpy(zero_copy_only=False)
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        raw, at = ranks.decode(lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)]))
        if at[-1] > np.iinfo(np.int32).max:
            raise ValueError("the texts of a batch are longer than it can hold")
        decoded = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
        if missing.any():
            decoded = pa.array([None if gone else x for gone, x in zip(missing, decoded.to_pylist(), strict=True)], pa.binary())
        yield pa.record_batch([*batch.columns, decoded], [*batch.schema.names, "decoded"])


def _schema(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{c}` {kind}, " for c, kind in df.dtypes if c in names)


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` (but those named as new ones) with n_tokens and ids, an array of ints."""
    keep = tuple(c for c in keep if c not in NEW)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c != "text"], "text")
    return rows.mapInArrow(lambda it: _encode(it, path, pattern), f"{_schema(rows, [c for c in keep if c != 'text'])}n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids (null: null)."""
    rows = encoded.drop("decoded")
    return rows.mapInArrow(lambda it: _decode(it, path, pattern), f"{_schema(rows, rows.columns)}decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """What ``decode(encode(docs))`` gives, in one pass: the worker that encoded a slice decodes it, so no batch of ids waits."""
    keep = tuple(c for c in keep if c not in (*NEW, "text"))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], "text")
    return rows.mapInArrow(lambda it: _decode(_encode(it, path, pattern), path, pattern), f"{_schema(rows, list(keep))}n_tokens long, ids array<int>, decoded binary")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(documents(spark, sf_dir), default_vocabulary(), default_pattern())
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", "n_tokens", F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op13_byte_bpe": op13_byte_bpe}
ORACLE: dict[str, str] = {}
