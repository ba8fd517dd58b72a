"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a seed and its code point. A trigram of letters is the product of their vectors,
rotated by place; a text is the sum of its trigrams, a language the sum of its training texts, and a text gets the language whose prototype
has the largest cosine with it. Letters are lower-cased; all else is one boundary sign between words.

Training takes every row with a language that is not held out, whole texts: each task sums up trigram counts, which are then bundled. The
driver holds one prototype of DIM floats (8 kB) a language and broadcasts their table: languages number some thousands, whatever the texts.

Defined results: a null text, or one without a letter, gets ``und`` and score 0; without a training row all get that; of equal cosines the
language that sorts first wins; a null doc_id is held out; equal rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, held_out, slices

DIM, SEED = 1024, 7
#: Bytes of text worked on at a time.
SLICE = 1 << 18


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@cache
def letter_vector(code: int) -> np.ndarray:
    return (np.random.default_rng([SEED, code]).integers(0, 2, DIM) * 2 - 1).astype(np.int8)


def bind(codes: np.ndarray) -> np.ndarray:
    """Vectors of trigrams, given as rows of three code points (0: boundary)."""
    out = np.ones((len(codes), DIM), np.int8)
    for place in range(3):
        letters, at = np.unique(codes[:, place], return_inverse=True)
        table = np.stack([np.roll(letter_vector(int(c)), 2 - place) for c in letters]) if len(letters) else np.zeros((0, DIM), np.int8)
        out *= table[at]
    return out


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Packed trigrams (21 bits a letter) of all texts, and the row of each. The middle one is always a letter."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(lowered)), [len(t) + 1 for t in lowered])
    codes[~_is_letter()[codes]] = 0
    middle = np.flatnonzero(codes[1:-1]) + 1
    return codes[middle - 1] << 42 | codes[middle] << 21 | codes[middle + 1], row[middle - 1]


def _unpack(packed: np.ndarray) -> np.ndarray:
    return np.stack([packed >> 42, packed >> 21 & 0x1FFFFF, packed & 0x1FFFFF], 1)


def _compact(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams and the place of each among them, by a table rather than by sorting where the letters are few."""
    used = np.zeros(0x110000, bool)
    used[packed >> 21 & 0x1FFFFF] = used[packed >> 42] = used[packed & 0x1FFFFF] = True
    letters = np.flatnonzero(used)
    n = len(letters)
    if n > 128:
        return np.unique(packed, return_inverse=True)
    small = np.zeros(0x110000, np.int64)
    small[letters] = np.arange(n)
    dense = (small[packed >> 42] * n + small[packed >> 21 & 0x1FFFFF]) * n + small[packed & 0x1FFFFF]
    seen = np.zeros(n**3, bool)
    seen[dense] = True
    at = np.flatnonzero(seen)
    place = np.zeros(n**3, np.int64)
    place[at] = np.arange(len(at))
    return letters[at // (n * n)] << 42 | letters[at // n % n] << 21 | letters[at % n], place[dense]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language of what a task reads; sums go on while the table of a task is small."""
    totals: dict[str, dict[int, int]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in totals.items():
            yield pa.record_batch([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["lang", "trigram", "n"])
        totals.clear()

    for batch in batches:
        for part in slices(batch, "text", SLICE):
            langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
            packed, row = trigrams(texts)
            names = sorted(set(langs))
            distinct, at = _compact(packed)
            lang_of = np.array([names.index(x) for x in langs], np.int64)[row]
            table = np.bincount(lang_of * len(distinct) + at, minlength=len(names) * len(distinct)).reshape(len(names), len(distinct))
            for name, counts in zip(names, table, strict=True):
                sums = totals.setdefault(name, {})
                for k in np.flatnonzero(counts):
                    sums[t] = sums.get(t := int(distinct[k]), 0) + int(counts[k])
        if sum(map(len, totals.values())) > 200_000:
            yield from out()
    yield from out()


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        packed, n = batch.column("trigram").to_numpy(), batch.column("n").to_numpy().astype(np.float64)
        for start in range(0, len(packed), 4096):
            stop = start + 4096
            vectors = bind(_unpack(packed[start:stop])).astype(np.float64)
            for lang in set(langs[start:stop]):
                mine = langs[start:stop] == lang
                sums[lang] = sums.get(lang, 0) + n[start:stop][mine] @ vectors[mine]
    for lang, v in sums.items():
        yield pa.record_batch([pa.array([lang], pa.string()), pa.array([v.tolist()], pa.list_(pa.float64()))], ["lang", "vector"])


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """The prototype of each language in ``labelled`` (text, lang); exact sums of integers, so reruns agree."""
    counts = labelled.where("text is not null and lang is not null").select("text", "lang").mapInArrow(_count, "lang string, trigram long, n long")
    counts = counts.groupBy("lang", "trigram").agg(F.sum("n").alias("n"))
    parts = counts.mapInArrow(_bundle, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    # As Arrow columns: DIM floats a language, without a Python object for each.
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).select("lang", "v.x").orderBy("lang").toArrow()
    table = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, DIM)
    return dict(zip(rows.column("lang").to_pylist(), table, strict=True))


def cosines(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of each text with each row of ``table`` (unit vectors), and whether it has a letter."""
    packed, row = trigrams(texts)
    out = np.zeros((len(texts), len(table)))
    if len(packed):
        distinct, at = _compact(packed)
        bundle = np.zeros((len(texts), DIM))
        counts = np.bincount(row * len(distinct) + at, minlength=len(texts) * len(distinct)).reshape(len(texts), -1).astype(np.float32)
        for start in range(0, len(distinct), 2048):
            bundle += counts[:, start : start + 2048] @ bind(_unpack(distinct[start : start + 2048])).astype(np.float32)
        norm = np.linalg.norm(bundle, axis=1, keepdims=True)
        out = bundle / np.where(norm > 0, norm, 1) @ table.T
    return out, np.bincount(row, minlength=len(texts)) > 0


def _score(batches: Iterator[pa.RecordBatch], names: list[str], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "text"]
        for part in slices(batch, "text", SLICE):
            for start in range(0, part.num_rows, 64):
                few = part.slice(start, 64)
                fit, known = cosines(few.column("text").to_pylist(), table)
                best = np.argmax(np.round(fit, 9), axis=1) if names else np.zeros(few.num_rows, int)
                known &= bool(names)
                pred = [names[b] if k else "und" for b, k in zip(best, known, strict=True)]
                score = np.where(known, np.clip(fit[np.arange(len(best)), best] if names else 0.0, 0.0, 1.0), 0.0)
                yield pa.record_batch([*[few.column(c) for c in rest], pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*rest, "lang_pred", "score"])


def identify(docs: DataFrame, learned: dict[str, np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` (but those named as new ones), with lang_pred and score."""
    spark, names = docs.sparkSession, sorted(learned)
    keep = tuple(c for c in keep if c not in ("lang_pred", "score"))
    table = np.stack([learned[x] / max(np.linalg.norm(learned[x]), 1e-12) for x in names]) if names else np.zeros((0, DIM))
    rows = docs.select(*keep, F.col(text).alias("text"))
    schema = "".join(f"`{c}` {kind}, " for c, kind in rows.dtypes if c in keep)
    shared = spark.sparkContext.broadcast(table)
    return rows.mapInArrow(lambda it: _score(it, names, shared.value), f"{schema}lang_pred string, score double")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", held_out())
    learned = prototypes(docs.where(~F.col("held_out")))
    return identify(docs, learned, keep=("doc_id", "held_out"))


QUERIES = {"op3_language": op3_language}
ORACLE: dict[str, str] = {}
